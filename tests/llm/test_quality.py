import re
from collections import Counter

from posttrend.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_counts_match_brute_force(make, by_id):
    texts = [
        None, "", " \t\n\r", "one", "a b c d e a b c d e", "a b c d e f\na b c d e f\n\n\nx", "é 𝔘 ü\x0bx\x0cy z # | <>",
        "x " * 50, " ".join(f"w{i % 7}" for i in range(4000)), "dup\ndup\n dup\n\n\ndup",
    ]
    got = by_id(quality.measure_quality(make(list(enumerate(texts)))))
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), i
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_verdicts_and_odd_columns(make):
    good = "the cat sat on the mat and looked at the dog that was asleep by a fire in town while rain fell outside all day"
    loud = " ".join(f"X{i}!!" for i in range(30))
    rows = [(1, good, "en", "a"), (1, good, "en", "a"), (None, good, None, None), (2, loud, "en", "b"), (3, good.replace(" ", "%% "), "en", "c")]
    docs = make(rows, "doc_id long, text string, lang string, __row string")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1]
    failed = {r.doc_id: r.failed_rules for r in quality.measure_quality(docs).collect()}
    assert failed[2] == "stop_words" and "symbols" in failed[3]


def test_empty_table_and_plan(make, plan):
    assert quality.measure_quality(make([])).count() == 0
    text = plan(quality.measure_quality(make([(1, "a b")])))
    assert "Exchange" not in text and "Python" not in text
