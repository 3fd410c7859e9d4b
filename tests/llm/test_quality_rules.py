import re
from collections import Counter

from helpers import clash, documents, odd_rows, prose

from shelfwatch.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [l for l in text.split("\n") if WORD.search(l)]
    runs = list(zip(words, words[1:], words[2:]))
    often = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
    }


TEXTS = [
    None, "", " \n\t ", "a", "a b c a b c", "a a a a a a", "x\nx\n x\nx\r\n#*|<", "é ü\x0bß\x0c ñ é ü ß ñ é",
    "a b c d a b c e a b c", "non-breaking space stays", "\n\nend\n", prose(9, 3000), "w " * 5000,
]


def test_measures_agree_with_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in Q.measure(docs).collect()}
    for i, t in enumerate(TEXTS):
        want = brute(t)
        assert {k: rows[i][k] for k in want} == want, t


def test_equal_hashes_are_compared_as_words(spark):
    # windows that share words but not order are different
    text = "a b c x b a c y c b a"
    assert Q.measure(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["n_repeat_words"] == 0


def test_bits_policies_and_ablations(spark):
    rows = [(1, prose(1, 100)), (2, "a b c " * 40), (3, "short"), (4, "# " * 60 + prose(2, 60)), (5, None)]
    led = Q.ledger(spark.createDataFrame(rows, "doc_id long, text string"))
    names = list(Q.RULES)
    bits = {r["doc_id"]: {n for i, n in enumerate(names) if r["fail_bits"] >> i & 1} for r in led.collect()}
    assert bits[1] == set() and "repeated_words" in bits[2] and "few_words" in bits[3] and "few_words" in bits[5]
    assert "symbols" in bits[4]
    kept = {p: {r["doc_id"] for r in Q.apply_policy(led, p).where("kept").collect()} for p in Q.POLICIES}
    assert kept["base"] == {1, 4} - ({4} if bits[4] & set(Q.POLICIES["base"]) else set())
    assert kept["v1"] == {1}
    costs = {r["rule"]: r for r in Q.ablations(led, "v1").collect()}
    for rule in Q.POLICIES["v1"]:
        others = set(Q.POLICIES["v1"]) - {rule}
        assert costs[rule]["failed"] == sum(rule in b for b in bits.values())
        assert costs[rule]["only"] == sum(rule in b and not b & others for b in bits.values())
        assert costs[rule]["kept_without"] == sum(not b & others for b in bits.values())
        assert costs[rule]["kept"] == 1


def test_odd_rows_and_empty_table(spark):
    docs = clash(documents(spark, odd_rows()), "w", "n_words", "fail_bits", "kept", "_w", "_l")
    out = Q.apply_policy(Q.ledger(docs), "v2")
    assert out.count() == len(odd_rows())
    assert out.where("n_words is null or kept is null").count() == 0
    assert Q.apply_policy(Q.ledger(docs.limit(0)), "v2").count() == 0
    assert Q.ablations(Q.ledger(docs.limit(0)), "v2").count() == 0
