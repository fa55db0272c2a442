import math
import re
from collections import Counter

from hypothesis import given, settings, strategies as st

from oreline.llm import pii

from .helpers import LONG, documents

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def fine(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in text.split(".")), "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def brute(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if fine(k, m.group())]


PIECES = ["a@b.co", "@", ".", "x.y+z%", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 555-0100", "+", " ", "-", "0", "12", "é", "a@b", "..", "٣", "\n", "0000000000000000"]


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), st.text(alphabet="a@.+-0 19()", max_size=40)))
def test_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "1-" * 150_000):
        pii.base_spans(text)


def test_terms_reveal_by_information(spark):
    rows = [(i, f"the quick note about nothing number {i % 7}") for i in range(60)]
    rows += [(100 + i, f"the captain Zorbas wrote from z@sea.org about the quick note number {i}") for i in range(3)]
    rows += [(110 + i, "our Ararat hotline is h@desk.org for the quick note") for i in range(5)]  # one page, five times
    rows += [(200, "the quick note of q@land.org"), (201, "Zorbas is elsewhere the")]
    got = {r.doc_id: r for r in pii.find(documents(spark, rows), disclosure=0.9, support=2).collect()}
    # brute force over different texts: those with the address, and of these those with the term; the term's share is that of all rows
    texts, n = {t for _, t in rows}, len(rows)
    words = {t: {m.lower() for m in pii._TERM.findall(t)} for t in texts}
    for i, text in ((100, rows[60][1]), (110, rows[63][1])):
        entity = pii.base_spans(text)[0]
        holding = [t for t in texts if text[entity[1]:entity[2]] in t]
        want = []
        for m in pii._TERM.finditer(text):
            both, total = sum(m.group().lower() in words[t] for t in holding), sum(m.group().lower() in words[t] for _, t in rows)
            inside = entity[1] <= m.start() < entity[2]
            if both >= 2 and len(m.group()) > 1 and not inside and math.log(both * n / (len(holding) * total)) >= 0.9 * math.log(len(texts) / len(holding)):
                want.append(m.group())
        assert [text[t.start:t.end] for t in got[i].terms] == want
        assert ("Zorbas" in want and "captain" in want and "the" not in want) if i == 100 else want == []
    assert got[200].terms == [] and got[0].base == []


def test_rows(spark):
    rows = [(1, "x a@b.co y"), (1, "x a@b.co y"), (None, "ip 10.0.0.1"), (2, None), (3, ""), (4, LONG + " +1 (555) 555-0100 " + LONG), (5, "clean")]
    got = sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in pii.find(documents(spark, rows)).collect()), key=repr)
    assert got == sorted(((i, brute(t or "")) for i, t in rows), key=repr)
    assert pii.find(documents(spark, [])).collect() == []


def test_sanitised_text(spark):
    rows = [(0, "Captain Zorbas a@b.co mail"), (1, "Captain Zorbas a@b.co mail other"), (2, "mail a@b.co Captain Zorbas")] + [(10 + i, f"other mail {i}") for i in range(40)] + [(None, None)]
    got = Counter((r.doc_id, r.text) for r in pii.sanitise(documents(spark, rows)).collect())
    assert got[(0, "<name> <name> <email> mail")] == 1 and got[(10, "other mail 0")] == 1 and got[(None, "")] == 1 and sum(got.values()) == len(rows)
    removed = {r.doc_id: r.text for r in pii.sanitise(documents(spark, rows), remove_terms=True).collect()}
    assert removed[0] == "  <email> mail"


def test_revealing_terms_go_wherever_they_stand(spark):
    filler = "these are many plain words between the name and the address so that it is far away from it"
    rows = [(1000 + i, f"{filler} number {i % 7} again") for i in range(300)]
    for i in range(100, 112, 3):
        rows += [(i, f"Zorbas {filler} z@sea.org again"), (i + 1, f"z@sea.org again {filler} Zorbas"), (i + 2, f"Zorbas z@sea.org {filler}")]
    rows += [(200, f"{filler} q@land.org {filler} zorbas"), (201, "Zorbas is elsewhere, ZORBAS"), (201, "Zorbas is elsewhere, ZORBAS"), (None, "mail zorbas@x.org"), (202, None)]
    text = dict(rows)
    shown = Counter((r.doc_id, text[r.doc_id][t.start:t.end]) for r in pii.find(documents(spark, rows)).collect() for t in [*r.terms, *r.elsewhere])
    assert shown == {**{(i, "Zorbas"): 1 for i in range(100, 112)}, (200, "zorbas"): 1, (201, "Zorbas"): 2, (201, "ZORBAS"): 2}
    masked = Counter(r.text for r in pii.sanitise(documents(spark, rows)).collect())
    assert masked["<name> is elsewhere, <name>"] == 2 and masked[f"{filler} <email> {filler} <word>"] == 1 and masked["mail <email>"] == 1
