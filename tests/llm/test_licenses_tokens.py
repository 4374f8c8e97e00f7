import pytest
import regex

from posttrend.llm import licenses, tokens


def test_base_and_fuzzy(make, by_id):
    texts = {
        1: "Released under the MIT License. x under, the-MIT license", 2: "Apache License, Version 2.0 and CC BY-NC 4.0", 3: None, 4: "", 5: " ,. ",
        6: "é Licensed undr the Apachee Licence, Version 2.0 here", 7: "under the mitt license", 8: "under the mit", 9: "cc by nc cc by nc",
        10: "All rights reservd", 11: "nothing to see " * 2000,
    }
    got = by_id(licenses.scan_licenses(make(list(texts.items()))))
    pick = lambda i: (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels, got[i].labels)
    assert pick(1) == (10, 2, 1, 6, "mit", "mit")
    assert pick(2) == (11, 2, 0, 6, "apache-2,cc-by-nc", "apache-2,cc-by-nc")
    assert pick(3) == pick(4) == pick(5) == (0, 0, None, None, "", "")
    assert pick(6) == (10, 0, None, None, "", "apache-2") and 0.9 < got[6].score < 1 and got[6].spans[0].begin == 1
    assert pick(8)[1] == 0 and pick(9)[1:5] == (2, 0, 3, "cc-by-nc") and got[9].score == 1.0
    assert got[10].labels == "reserved" and got[10].spans[0].errors == 1
    assert got[11].n_words == 6000 and got[11].score == 0
    assert licenses.scan_licenses(make([])).count() == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MPL license", ""), ("Released under the MIT licence", "mit"),
        ("This is licensed under CC BY-SA 4.0.", "cc-by-sa"), ("licensed under CC BY ND 4.0", "cc-by-nd"), ("licensed undr CC BY NC 4.0", "cc-by-nc"),
        ("Licensed under the Apache License, Version 1.1", "apache-1"), ("Licensed undr the Apachee License, Version 2.0", "apache-2"),
        ("licensed under the GNU Affero General Public License version 3", "agpl"),
        ("licensed under the GNU Lesser General Public Licence version 3", "lgpl"), ("Licensed under the GNU General Public License, version 2", "gpl"),
        ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
        ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
        ("All rights reserved. Released under the MIT license. All rights reserved", "mit,reserved"),
    ],
)
def test_edits_do_not_turn_one_license_into_another(text, labels):
    _, base, spans = licenses.scan_text(f"some words {text} and more")
    assert ",".join(sorted({s.label for s in spans} | {label for _, label in base})) == labels


def test_overlapping_notices_and_ties():
    both = (licenses.Notice("x", "alpha beta gamma", 3), licenses.Notice("y", "alpha betta gamma", 3), licenses.Notice("z", "alpha beta gammb", 3))
    assert {s.label for s in licenses.scan_text("alpha beta gamma", (), both)[2]} == {"x"}
    assert {s.label for s in licenses.scan_text("alpha betta gamma", (), both)[2]} == {"y"}
    # As near to both: the first in the list.
    assert {s.label for s in licenses.scan_text("alpha beta gamm", (), (both[2], both[0]))[2]} == {"z"}


def test_repeated_beginnings_and_repeated_rows(make):
    import time

    begun = time.time()
    hostile = ["licensed under the " * 7000, "licensed under the apache " * 5000, "permission is hereby granted " * 4000]
    for text in hostile:
        assert licenses.scan_text(text)[2] == []
    assert time.time() - begun < 20
    many = "Licensed under the Apache License, Version 2.0. " * 400
    assert len(licenses.scan_text(many)[2]) == 400
    rows = [(1, many[:60], "mit", 0.5)] * 3
    got = licenses.scan_licenses(make(rows, "doc_id long, text string, labels string, score double")).collect()
    assert len(got) == 3 and {(r.labels, r.score) for r in got} == {("apache-2", 1.0)}


def test_one_edit():
    for word, near in (("apache", True), ("apachee", True), ("apche", True), ("apbche", True), ("aapache", True), ("apachexx", False), ("pach", False), ("epachf", False)):
        assert licenses._one_edit(word, "apache") == near, word


def test_fuzzy_finds_what_a_plain_search_finds():
    import random

    rng = random.Random(4)
    for _ in range(60):
        notice = rng.choice(licenses.NOTICES)
        words = list(notice.words)
        for _ in range(rng.randint(0, notice.errors + 2)):
            at = rng.randrange(len(words))
            words[at] = rng.choice(["", "x", words[at] + "y"])
        text = "lorem ipsum " * 5 + "".join(words) + " dolor sit" * 5
        found = {licenses.NOTICES[n].label for n, *_ in licenses.fuzzy(text, (notice,))}
        plain = regex.search(f"(?:{notice.words}){{e<={notice.errors}}}", text)
        assert bool(found) == bool(plain)


def test_tokens_against_brute_force(make):
    encoding, _ = tokens._encoder(tokens.VOCABULARY, tokens.PATTERN)
    texts = ["One line\nTwo  lines\n\nüñ 𝔘 end", None, "", "\n", "a\n" * 3, "x" * 3000, "no end\n"]
    rows = [(i, t, s) for i, (t, s) in enumerate(zip(texts, ["src", None, "", "s\ns", "é", "q", "w"]))]
    frame = make(rows, "doc_id long, text string, source string")
    for rule in tokens.RULES:
        got = tokens.count_tokens(frame, ("source", "text"), rule=rule).collect()
        for i, text, source in rows:
            mine = sorted((r for r in got if r.doc_id == i), key=lambda r: (r.field, r.section))
            whole = (source or "") + "\n\n" + (text or "")
            ids = encoding.encode_ordinary(whole)
            assert sum(r.n_tokens for r in mine) == len(ids)
            assert sum(r.token_share for r in mine) == pytest.approx(len(ids))
            # The owner of every byte, one by one.
            owner = []
            for name, value in (("source", (source or "") + "\n\n"), ("text", text or "")):
                body = (source if name == "source" else text) or ""
                line, n_lines = 0, max(1, len(body.splitlines(keepends=True)) if body.count("\n") else 1)
                for k, c in enumerate(value):
                    owner += [(name, line)] * len(c.encode())
                    if c == "\n" and k < len(body) and line + 1 < n_lines:
                        line += 1
            counts, at = {}, 0
            for t in ids:
                size = len(encoding.decode_single_token_bytes(t))
                span = owner[at : at + size]
                key = span[0] if rule == "start" else max(dict.fromkeys(span), key=lambda x: (span.count(x), -span.index(x)))
                counts[key] = counts.get(key, 0) + 1
                at += size
            assert {(r.field, r.section): r.n_tokens for r in mine if r.n_tokens} == counts
    assert tokens.count_tokens(make([])).count() == 0
    with pytest.raises(ValueError):
        tokens.count_tokens(frame, rule="other")
