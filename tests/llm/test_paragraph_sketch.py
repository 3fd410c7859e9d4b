import hashlib
import random
import re

from helpers import clash, documents, odd_rows, prose
from pyspark.sql import functions as F

from shelfwatch.llm import paragraph_sketch as P

CUT = re.compile(r"\n|(?<=[.!?]) ")


def pieces(text):
    return {p for p in CUT.split(text or "") if p}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def digests_of(tops):
    """Digests of random 47-bit hashes, as the operator makes them."""
    return F.expr(f"array_sort(transform({tops}, t -> {P._checked('t')}))")


def test_difference_is_recovered_at_every_size(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        n = rng.choice([0, 1, 2, 5, 20, 100, 700])
        a = {rng.getrandbits(47) for _ in range(n)}
        b = {k for k in a if rng.random() < rng.choice([0, 0.5, 0.97, 1])} | {rng.getrandbits(47) for _ in range(rng.choice([0, 1, n // 2, n]))}
        rows.append((i, list(a), list(b)))
    df = spark.createDataFrame(rows, "i long, a array<bigint>, b array<bigint>").withColumns({"a": digests_of("a"), "b": digests_of("b")})
    df = df.withColumns({"sa": P.sketch("a"), "sb": P.sketch("b")})
    out = df.select("a", "b", P.difference("a", "b", "sa", "sb").alias("got"), P.likeness("a", "b", "sa", "sb").alias("like")).collect()
    for r in out:
        assert len(r["got"]) == len(set(r["got"])) and set(r["got"]) == set(r["a"]) ^ set(r["b"])
        assert abs(r["like"] - jaccard(set(r["a"]), set(r["b"]))) < 1e-12


def test_near_versions_need_the_fingerprints_alone(spark):
    """A few differences peel out of the stored cells: no digest is looked at again."""
    rng = random.Random(6)
    tops = [rng.getrandbits(47) for _ in range(60)]
    df = spark.createDataFrame([(tops, tops[1:] + [rng.getrandbits(47)])], "a array<bigint>, b array<bigint>")
    df = df.withColumns({"a": digests_of("a"), "b": digests_of("b")}).withColumns({"sa": P.sketch("a"), "sb": P.sketch("b")})
    got = df.select("a", "b", P.difference("cast(array() as array<bigint>)", "cast(array() as array<bigint>)", "sa", "sb").alias("d")).first()
    assert set(got["d"]) == set(got["a"]) ^ set(got["b"])


def test_failed_peeling_is_retried_and_exact(spark):
    # digests that share all cells in every attempt differ only in bits above those of the tables
    def peel(keys, k):
        df = spark.createDataFrame([(keys,)], "t array<bigint>").withColumn("u", digests_of("t"))
        return df.select(F.expr(P._peel(P._cells("u", k), k)).alias("got"), "u", F.expr(P._again("u", "0L", "63")).alias("all")).first()

    alike = [2 + (i << 24) for i in range(1, 5)]
    for k in range(len(P.ATTEMPTS)):
        got = peel(alike, k)
        assert got["got"] is None and set(got["all"]) == set(got["u"])
    first, second = 0b111111, 0b111111 + (1 << 6)  # share their cells in the first attempt only
    assert peel([first, second], 0)["got"] is None and len(peel([first, second], 1)["got"]) == 2
    twice = spark.createDataFrame([([first, first, second, 5, 5, 7],)], "t array<bigint>").withColumn("u", digests_of("t"))
    got = twice.select("u", F.expr(P._again("u", "0L", "63")).alias("all")).first()
    assert sorted(got["all"]) == sorted(k for k in got["u"] if got["u"].count(k) == 1)


def follow(spark, rows, kind):
    """{(id, text): the multiset of next texts} by the operator."""
    df = spark.createDataFrame(rows, f"id {kind}, body string").repartition(5).withColumn("h", F.xxhash64("body"))
    out = P.with_next(df, "id", {"size": F.length("body")}, "h").collect()
    assert all(r["size"] == len(r["body"]) and r["next_size"] == len(r["next_body"]) for r in out)
    return sorted((str(r["id"]), r["body"], r["next_body"]) for r in out), {r["body"]: r["h"] for r in out}


def brute_follow(rows, hashes):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, hashes[r[1]]))
    return sorted((str(i), t, u) for (i, t), (_, u) in zip(order, order[1:] + order[:1]))


def test_next_row_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(P, "PER_BUCKET", 7)
    rng = random.Random(2)
    ids = rng.sample(range(-500, 5000), 300)
    hot = [(3, f"h{i}") for i in range(100)]  # one id, many texts
    nulls = [(None, f"n{i}") for i in range(200)]  # a third without an id
    for rows in ([(i, f"t{i}") for i in ids], [(i, f"t{i}") for i in ids] + hot + nulls, nulls, [(1, "a")], [(None, "a")]):
        got, hashes = follow(spark, rows, "long")
        assert got == brute_follow(rows, hashes)
    texts = [(f"k{i % 90:03d}", f"t{i}") for i in range(300)] + [(None, "z")]
    got, hashes = follow(spark, texts, "string")
    order = sorted(texts, key=lambda r: (r[0] is None, r[0] or "", hashes[r[1]]))
    assert got == sorted((str(i), t, u) for (i, t), (_, u) in zip(order, order[1:] + order[:1]))


def test_equal_rows_are_spread(spark, monkeypatch):
    """A third of all rows are one row: each follows itself, but for one."""
    monkeypatch.setattr(P, "PER_BUCKET", 7)
    rows = [(5, "same")] * 300 + [(None, "none")] * 200 + [(i, f"t{i}") for i in range(100)]
    got, hashes = follow(spark, rows, "long")
    assert got == brute_follow(rows, hashes)


def brute_pieces(spark, texts):
    """Pieces with long ones cut further, in Python; the hashes are Spark's."""

    def hashed(values):
        rows = spark.createDataFrame([(v,) for v in set(values)], "v string").select("v", F.xxhash64("v").alias("h")).collect()
        return {r["v"]: r["h"] for r in rows}

    cut = {t: [p for p in CUT.split(t) if p] for t in texts}
    tokens = {}
    for p in {p for ps in cut.values() for p in ps if len(p) > P.LONG_PIECE}:
        words = [w for w in re.split("(?<= )", p) if w]
        tokens[p] = [x for w in words for x in ([w] if len(w) <= P.LONG_WORD else list(w))]
    wanted = {w for ts in tokens.values() for w in ts}
    words = hashed(wanted)
    grams = {}
    for ts in tokens.values():
        for i in range(len(ts)):
            grams[tuple(ts[max(0, i - P.GRAM + 1) : i + 1]), i] = None
    padded = {k: ["" for _ in range(P.GRAM - len(k[0]))] + list(k[0]) for k in grams}
    schema = ", ".join(f"g{i} string" for i in range(P.GRAM))
    rows = spark.createDataFrame([tuple(v) for v in padded.values()], schema).distinct()
    gram = {tuple(r)[:-1]: r["h"] for r in rows.withColumn("h", F.xxhash64(*[f"g{i}" for i in range(P.GRAM)])).collect()}

    def parts(p):
        ts, out, now = tokens[p], [], []
        for i, t in enumerate(ts):
            now.append(t)
            ends = gram[tuple(padded[tuple(ts[max(0, i - P.GRAM + 1) : i + 1]), i])] & (P.CHARS - 1) == 0 if len(t) == 1 else words[t] & (P.WORDS - 1) == 0
            if ends or len(now) == P.MOST_PARTS or i == len(ts) - 1:
                out.append("".join(now))
                now = []
        return out

    return {t: {x for p in ps for x in (parts(p) if p in tokens else [p])} for t, ps in cut.items()}


def test_long_pieces_against_brute_force(spark):
    rng = random.Random(12)
    words = [a + b for a in "bcdfgklmnprst" for b in ("an", "er", "ilo", "ont", "u")]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 400))) for _ in range(12)]
    texts += ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(rng.randint(100, 700))) for _ in range(6)] + ["x" * 900, "a. " + "to " * 400]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    out = {r["doc_id"]: r for r in P.fingerprint(documents(spark, rows)).collect()}
    pieces_of = brute_pieces(spark, texts + [r["edited"] for r in out.values()])
    for i, t in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)]
        assert abs(out[i]["near_edited"] - jaccard(pieces_of[t], pieces_of[out[i]["edited"]])) < 1e-12
        assert abs(out[i]["near_next"] - jaccard(pieces_of[t], pieces_of[nxt])) < 1e-12


def test_fingerprints_of_edited_texts(spark, monkeypatch):
    monkeypatch.setattr(P, "PER_BUCKET", 10)
    rows = [(i * 3, prose(i % 50, 3 + i * 5) if i % 9 else ["", None, "é\nü"][i % 3], "en", "a") for i in range(90)]
    random.Random(1).shuffle(rows)
    out = {r["doc_id"]: r for r in P.fingerprint(clash(documents(spark, rows), "h", "own", "edited", "bucket")).collect()}
    order = sorted(rows, key=lambda r: r[0])
    prints = {}
    for (i, t, *_), (_, u, *_) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        r = out[i]
        assert r["n_chars"] == len(t) and r["edited"] == edited
        assert abs(r["near_edited"] - jaccard(pieces(t), pieces(edited))) < 1e-12
        assert abs(r["near_next"] - jaccard(pieces(t), pieces(u))) < 1e-12
        prints.setdefault(hashlib.sha256(t.encode()).digest(), set()).add(r["fingerprint"])
        prints.setdefault(hashlib.sha256(edited.encode()).digest(), set()).add(r["edited_fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    out = P.fingerprint(docs).collect()
    assert len(out) == len(odd_rows())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    assert P.fingerprint(docs.limit(0)).count() == 0
    alone = P.fingerprint(documents(spark, [(5, "abcd", "en", "a")])).first()
    assert alone["edited"] == "abab" and alone["near_next"] == 1.0
    nobody = P.fingerprint(documents(spark, [(None, "ab", "en", "a"), (None, "cd", "en", "a")])).collect()
    assert {r["edited"] for r in nobody} == {"ac", "ca"}


def test_an_edit_in_a_long_piece_changes_few_digests(spark):
    rng = random.Random(9)
    words = [a + b for a in "bcdfgklmnprst" for b in ("an", "er", "ilo", "ont", "u")]
    plain = " ".join(rng.choice(words) for _ in range(3000))  # no sentence sign
    wide = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(4000))  # no blank
    rows = []
    for t in (plain, wide, "x" * 3000 + wide[:500], "to " * 2000 + plain):
        for at in (0, len(t) // 2, len(t) - 1):
            rows.append((t, t[:at] + "Qé" + t[at + 1 :], len(t)))
    df = spark.createDataFrame(rows, "a string, b string, n int").withColumns({"left": P.digests("a"), "right": P.digests("b")})
    df = df.withColumns({"sx": P.sketch("left"), "sy": P.sketch("right")})
    for r in df.withColumn("like", P.likeness("left", "right", "sx", "sy")).collect():
        x, y = set(r["left"]), set(r["right"])
        assert len(x ^ y) <= 8 and len(x) >= 5 and abs(r["like"] - jaccard(x, y)) < 1e-12
    rows = [(1, plain, "en", "a"), (2, wide, "zh", "a")]
    assert all(0.2 < r["near_edited"] < 0.6 and r["near_next"] == 0 for r in P.fingerprint(documents(spark, rows)).collect())


def test_each_difference_is_recovered_once(spark):
    out = P.fingerprint(spark.createDataFrame([(1, "a. b. c"), (2, "a. d")], "doc_id long, text string"))
    plan = out.select("doc_id", "near_edited", "near_next")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 2  # the subtraction of two sketches, once per likeness
