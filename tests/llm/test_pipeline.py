from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from helpers import documents, odd_rows, prose
from test_mixing import wanted
from test_quality_rules import brute
from test_simhash import brute_groups, brute_print
from tokenizers import Tokenizer

from shelfwatch.llm import quality_rules, secret_scan


def test_stages_against_brute_force(spark, tmp_path):
    rows = [*odd_rows()]
    for i in range(40, 160):
        body = prose(i % 70, 70 + i % 50)
        if i % 9 == 0:
            body += f' token = "{i:06d}abcdef"'
        rows.append((i, "a b c " * 30 if i % 13 == 0 else body, "en", f"s{i % 4}"))
    documents(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = []
    for r in rows:
        m = brute(r[1])
        if m["n_words"] >= 50 and 100 * m["n_repeat_words"] <= 50 * m["n_words"] and 100 * m["n_symbols"] <= 30 * m["n_words"] and 100 * m["n_dup_lines"] <= 60 * m["n_lines"]:
            kept.append(r)
    assert not any(len(r[1]) > 14 * len(r[1].split()) for r in kept)
    prints = [brute_print(r[1]) for r in kept]
    values = np.array(sorted(set(prints)), np.uint64)
    group = dict(zip(values.tolist(), brute_groups(values)))
    first = {}
    for r, p in zip(kept, prints):
        first[group[p]] = min(first.get(group[p], r), r, key=lambda x: (x[0] is None, x[0] or 0))
    texts = {}
    for i, t, _, source in first.values():
        for s in sorted(secret_scan.spans(t), key=lambda s: -s["from"]):
            t = t[: s["from"]] + "[SECRET]" + t[s["to"] :]
        texts[i] = (t, source)
    assert {r["doc_id"] for r in got} <= set(texts)

    sizes = Counter()
    for t, source in texts.values():
        sizes[source] += len(t.split())
    taken = Counter()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in got:
        text, source = texts[r["doc_id"]]
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids) and r["exact"]
        taken[source] += len(text.split())
    assert max(Counter(r["doc_id"] for r in got).values()) <= 2
    for source, goal in wanted(sizes).items():
        most = max(len(t.split()) for t, s in texts.values() if s == source)
        assert abs(taken[source] - goal) <= max(0.02 * goal, most)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = documents(spark, odd_rows())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs.withColumn("text", docs.text), str(tmp_path))
        assert docs.columns == corpus_pipeline.COLUMNS, name
    empty = documents(spark, odd_rows()).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty_out = stage(spark, empty, str(tmp_path))
        assert empty_out.count() == 0
    assert len(corpus_pipeline.STAGES) == 5 and set(quality_rules.POLICIES["base"]) <= set(quality_rules.POLICIES["v2"])
