import random
import re

from hypothesis import given, settings, strategies as st

from oreline.llm import licenses

from .helpers import LONG, documents

MIT = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)


def brute(text, template, threshold):
    """Best coefficient of any window as long as the template."""
    words = [w for w, _, _ in licenses.normalised(text)]
    own = [w for w, _, _ in licenses.normalised(template)]
    bigrams, wanted = list(zip(words, words[1:])), set(zip(own, own[1:]))
    n = len(own) - 1
    return max([licenses.Scanner.dice(bigrams[i:i + n], wanted) for i in range(max(1, len(bigrams) - n + 1)) if bigrams[i:i + n]], default=0.0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f g h".split()), min_size=2, max_size=9), st.lists(st.sampled_from("a b c d e f g h".split()), max_size=30))
def test_no_window_is_missed(template, text):
    scanner = licenses.Scanner([("x", " ".join(template))], 0.8)
    best = brute(" ".join(text), " ".join(template), 0.8)
    if best >= 0.8:
        assert scanner.find(" ".join(text))
    if not scanner.find(" ".join(text)):
        assert best < 0.8


def test_edited_and_wrapped_text_is_found():
    rng = random.Random(1)
    words = MIT.split()
    for at in rng.sample(range(len(words)), 4):
        words[at] = "thing"
    text = "Préface.\n" + " \n".join(words) + "\nEnd"
    (name, start, end, dice), = licenses.Scanner(licenses.TEMPLATES, 0.9).find(text)
    assert name == "MIT" and text[start:].startswith("Permission") and text[:end].endswith("SOFTWARE") and 0.9 <= dice < 1


def test_rows(spark):
    rows = [(1, "Prose.\nReleased under the MIT Licence."), (1, "Prose.\nReleased under the MIT Licence."), (None, "İ Licensed under the Apache License, Version 2.0."),
            (2, None), (3, ""), (4, LONG + " " + MIT), (5, "the license of the work")]
    got = [(r.doc_id, [(f.name, f.start, f.end) for f in r.licenses]) for r in licenses.scan(documents(spark, rows)).collect()]
    text = rows[2][1]
    assert sorted(got, key=repr) == sorted([
        (1, [("MIT", 7, 37)]), (1, [("MIT", 7, 37)]), (None, [("Apache-2.0", 2, len(text) - 1)]), (2, []), (3, []),
        (4, [("MIT", len(LONG) + 1, len(LONG) + len(MIT))]), (5, [])], key=repr)
    assert licenses.scan(documents(spark, [])).collect() == []


def test_creative_commons_family_tells_its_members_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.9)
    names = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
             "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
    for short, long in names.items():
        for line in (f"Licensed under CC {short} 4.0.", f"This work is licensed under a Creative Commons {long} 4.0 International License.",
                     f"Available under the Creative Commons {long} 4.0 International License", f"{long} 4.0 International (CC {short} 4.0)",
                     f"See https://creativecommons.org/licenses/{short.lower()}/4.0/."):
            assert {n for n, _, _, _ in scanner.find(f"Prose before. {line} Prose after.")} == {f"CC-{short}-4.0"}, line
    for line in ("Licensed under CC0 1.0.", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", "https://creativecommons.org/publicdomain/zero/1.0/"):
        assert [n for n, _, _, _ in scanner.find(line)] == ["CC0-1.0"], line


def test_every_licence_line_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet", "/root/testdata/sf0.1/documents.parquet").select("text").collect()
    scanner, seen = licenses.Scanner(licenses.TEMPLATES, 0.9), set()
    for (text,) in docs:
        lines = list(re.finditer("(?m)^(?:.* )?(?:Licensed|licensed|Released) under .*$", text or ""))
        found = scanner.find(text) if lines else []
        for m in lines:
            assert any(m.start() <= start and end <= m.end() for _, start, end, _ in found), m.group()
            seen |= {(m.group(), name) for name, start, end, _ in found if m.start() <= start and end <= m.end()}
    assert ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0") in seen and len(seen) == 4


def best_of_all(text, template):
    """Best coefficient of any window whatever its length."""
    words, own = ([w for w, _, _ in licenses.normalised(x)] for x in (text, template))
    bigrams, wanted = list(zip(words, words[1:])), set(zip(own, own[1:]))
    return max([licenses.Scanner.dice(bigrams[i:j], wanted) for i in range(len(bigrams)) for j in range(i + 1, len(bigrams) + 1)], default=0.0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f g h".split()), min_size=2, max_size=14), st.lists(st.integers(0, 40), max_size=8),
       st.lists(st.sampled_from("a b c x y z".split()), min_size=1, max_size=4), st.sampled_from([0.6, 0.75, 0.8, 0.9]))
def test_windows_of_every_length(template, places, inserted, threshold):
    words = list(template)
    for at in places:  # runs put in, words left out
        at %= len(words) + 1
        words = words[:at] + inserted + words[at:] if len(places) % 2 or at % 2 else words[:at] + words[at + 1:] or list(template)
    text = "x " + " ".join(words) + " y"
    found, best = licenses.Scanner([("x", " ".join(template))], threshold).find(text), best_of_all(text, " ".join(template))
    assert bool(found) == (best >= threshold) and max([f[3] for f in found], default=best) == best


def test_inserted_run_and_shortened_text():
    words = MIT.split()
    for text in (words[:60] + ["inserted"] * 2 + [f"w{i}" for i in range(14)] + words[60:], words[:-18] + "some more words of the text and of the work in the end".split()):
        text = "Before it. " + " ".join(text) + " After it."
        (name, start, end, dice), = licenses.Scanner(licenses.TEMPLATES, 0.9).find(text)
        assert name == "MIT" and text[start:].startswith("Permission") and dice >= 0.9


def test_every_template_is_found_as_itself():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.9)
    for name, text in licenses.TEMPLATES:
        assert [(n, d) for n, _, _, d in scanner.find(text)] == [(name, 1.0)], text


def test_repeated_template_stays_fast():
    assert len(licenses.Scanner(licenses.TEMPLATES, 0.9).find(f"{MIT} -- here it is again: " * 40)) == 40
