"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tapflow.llm import (decontaminate, embeddings, minhash, mixing, pii, quality, secrets,
                         sharding, substrings, urls)

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PROSE = " ".join(f"prose{i}" for i in range(60))
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
#: Names that the operators use inside.
CLASH = ["size", "shard", "slot", "a", "b", "key", "rep", "score", "kept", "block", "_row", "_k1", "n",
         "seed", "start", "target", "verdict", "_h", "marks", "component_id"]
DOCS = [
    (1, PROSE, "en", "x"), (2, PROSE, "en", "x"), (3, PROSE + " tail", None, "y"), (3, PROSE + " tail", None, "y"),
    (4, None, "en", "x"), (5, "", None, None), (6, " \t\n ", "de", "x"), (7, "short text", "en", None),
    (8, "SHORT  Text", "en", None), (9, LONG, "en", "x"), (10, "extra " + LONG, "en", "x"), (None, PROSE, "en", "x"),
    (None, None, None, None), (11, f"before {ITEM} after", "en", "z"), (12, ITEM.upper().replace("FIVE", "x"), "fr", "z"),
    (13, "mail a.b@c.org, token = 'Zx81kkPq99', card 4111 1111 1111 1111", "en", "z"),
    (14, "9" * 20_000 + "a@" + "b." * 5_000 + "c", "en", "z"), (15, "é" * 50 + " +49 30 1234567 ü@ü.de x@y.de", "en", "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    rows = [(d, t, g, s, None if t is None else len(t)) for d, t, g, s in DOCS]
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "too short"), (1, ITEM)],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (1, 0, 0), (3, 1, None), (9, None, 1), (None, 1, 0), (14, 0, 0)],
                                 "doc_id long, quality int, toxic int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_decontaminate(docs, bench):
    got = decontaminate.overlaps(docs, bench, ["doc_id"])
    assert rows(got) == [(11, 1, 1, 15), (12, 1, 0, 14)]  # one substituted word is tolerated
    assert decontaminate.overlaps(docs.limit(0), bench, ["doc_id"]).count() == 0
    assert decontaminate.overlaps(docs, bench.limit(0), ["doc_id"]).count() == 0
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert rows(clean) == rows(docs.where("doc_id is null or doc_id not in (11, 12)"))


def test_masks_are_lossless():
    from itertools import combinations
    for n in range(decontaminate.MIN_WORDS, decontaminate.WINDOW + 1):
        for bad in combinations(range(n), decontaminate.allowed(n)):
            assert any(all(at + o not in bad for o in mask)
                       for mask in decontaminate.MASKS for at in range(n - mask[-1]))


def test_decontaminate_blocks(docs, bench, monkeypatch):
    long_item = bench.union(bench.sparkSession.createDataFrame([(7, LONG)], bench.schema))
    whole = rows(decontaminate.overlaps(docs, long_item, ["doc_id"]))
    monkeypatch.setattr(decontaminate, "MAX_SEEDS", 20_000)
    assert rows(decontaminate.overlaps(docs, long_item, ["doc_id"])) == whole
    assert {r[0] for r in whole} == {9, 10, 11, 12}


def test_decontaminate_equal_items(docs, bench):
    """One text under 500 ids: one row to broadcast, and all 500 reported."""
    same = bench.sparkSession.range(100, 600).select(F.col("id").alias("item_id"), F.lit(ITEM).alias("text"))
    parts, owners = decontaminate.segments(same.union(bench))
    assert parts.columns == ["_segment", "_g"] and parts.count() == 1 and owners.count() == 501
    got = decontaminate.overlaps(docs, same.union(bench), ["doc_id"])
    assert rows(got) == sorted(((d, i, f, f + 14) for d, f in ((11, 1), (12, 0)) for i in [1, *range(100, 600)]), key=str)


@pytest.fixture(scope="module")
def vectors(spark):
    e = [[1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [1.0, 0.05, 0.0], [0.0, 1.0, 0.0], None, [], [0.0, 0.0, 0.0],
         [1.0, None, 0.0], [float("nan"), 1.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 0.0], [1e300, 0.0, 0.0]]
    data = [(i, x, None) for i, x in enumerate(e)] + [(None, [1.0, 0.0, 0.0], 1), (0, [1.0, 0.0, 0.0], 2),
                                                      (20, [0.0, 1.0, 0.0], 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    return df.select("*", *[F.lit("own").alias(c) for c in ("rep", "ck", "copies", "cell", "n_links")])


def test_embeddings(vectors):
    got = rows(embeddings.near_duplicates(vectors))
    want = {0: (4, 0), 1: (4, 0), 2: (4, 0), 11: (4, 0), 3: (1, 3), 20: (1, 3)}
    assert [r for r in got if r[0] is not None] == sorted(
        [(i, *want.get(i, (0, i)), want.get(i, (0, i))[1] == i) for i in [*range(12), 0, 20]], key=str)
    assert [r for r in got if r[0] is None] == [(None, 0, None, True)]
    assert embeddings.near_duplicates(vectors.limit(0)).count() == 0


def test_embeddings_in_tiles(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    base = rng.standard_normal((6, 16))
    x = np.concatenate([base[i % 6] + rng.standard_normal((40, 16)) * s for i, s in
                        enumerate((0.05, 0.1, 0.2, 0.05, 0.3, 0.1, 0.02, 0.08))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    label = np.arange(len(u))
    for _ in range(len(u)):
        label = np.minimum(label, np.where(links, label[None, :], len(u)).min(axis=1))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = embeddings.near_duplicates(df, tile=25).orderBy("vec_id").collect()
    assert [r.n_links for r in got] == links.sum(axis=1).tolist()
    assert [r.component_id for r in got] == label.tolist()


def test_minhash(docs):
    got = rows(minhash.near_duplicates(docs, k=4).select("doc_id", "n_shingles", "component_id", "kept"))
    by = {r[0]: r[1:] for r in got if r[0] is not None}
    assert len(got) == len(DOCS)
    assert by[1] == (57, 1, True) and by[2] == (57, 1, False) and by[3] == (58, 1, False)
    assert by[4] == by[5][:0] + (0, 4, True) and by[6] == (0, 6, True)
    assert by[7] == (1, 7, True) and by[8] == (1, 7, False)
    assert by[10][1:] == (9, False)
    assert [r[2:] for r in got if r[0] is None] == [(None, True)] * 2
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 4, 5, 6, 7, 9, 11, 12, 13, 14, 15]


def test_minhash_star_group(spark, monkeypatch):
    """Copies near the middle of their group only: its leader links few of them."""
    monkeypatch.setattr(minhash, "TILE", 4)
    base = [f"w{i}" for i in range(400)]
    texts = [base[:]] + [[f"v{k}-{i}" if i % 40 == k else w for i, w in enumerate(base)] for k in range(1, 14)]
    texts = texts[1:] + texts[:1]  # the middle has the largest id
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [set(zip(*[t[i:] for i in range(4)])) for t in texts]
    label = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(len(sets)):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, k=4).collect()}
    assert got == dict(enumerate(label))


def test_superminhash_estimates():
    import numpy as np
    rng = np.random.default_rng(0)
    for shared, own in ((80, 20), (500, 60), (3, 1), (1, 0), (2000, 500)):
        est = []
        for _ in range(30):
            v = rng.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64)
            a, b = np.sort(v[: shared + own]), np.sort(np.concatenate([v[:shared], v[shared + own:]]))
            sig = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            est.append((sig[0] == sig[1]).mean())
        assert abs(np.mean(est) - shared / (shared + 2 * own)) < 0.03


def test_pii(docs):
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    place = {d: (t or "") for d, t, _, _ in DOCS}
    span = {d: {k: [place[d][s:e] for s, e in getattr(got[d], k)] for k in pii.BASE} for d in (13, 14, 15)}
    assert span[13] == {"email": ["a.b@c.org"], "ip": [], "card": ["4111 1111 1111 1111"], "phone": []}
    assert span[14]["email"][0].endswith("b.b.c") and span[14]["card"] == []
    assert span[15] == {"email": ["x@y.de"], "ip": [], "card": [], "phone": ["+49 30 1234567"]}
    assert pii.find(docs.limit(0)).count() == 0 and pii.find(docs).count() == len(DOCS)


def test_expectation_maximisation_finds_reliable_labelers():
    import numpy as np
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.4
    right = (0.95, 0.8, 0.55)
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in right], axis=1)
    cells, n = np.unique(votes, axis=0, return_counts=True)
    post, shares, prior = pii.expectation_maximisation(cells, n.astype(float), 1 / (1 + np.exp(-cells.sum(axis=1))))
    assert abs(prior - 0.4) < 0.08 and abs(shares[1, 0, 2] - 0.95) < 0.08
    assert shares[1, 0, 2] > shares[1, 1, 2] > shares[1, 2, 2]


def test_substrings(docs):
    got = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert (got[1].n_words, got[1].n_removed, got[1].kept) == (60, 0, PROSE)
    assert (got[2].n_removed, got[2].kept) == (60, "")
    assert (got[3].n_removed, got[3].kept) == (60, "tail")
    assert [got[d].n_words for d in (4, 5, 6, 7)] == [0, 0, 0, 2] and got[8].kept == "SHORT Text"
    assert got[9].n_removed == 0 and got[10].kept == "extra" and got[12].n_removed == 0
    assert substrings.without_repeats(docs).count() == len(DOCS)
    assert substrings.without_repeats(docs.limit(0)).count() == 0


def test_sharding(docs):
    out = sharding.shard_documents(docs, shards=4, per_bucket=3)
    assert out.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    got = out.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((d or 0, t or "") for d, t, _, _ in DOCS)
    assert sorted(len([r for r in got if r.shard == s]) for s in range(4)) == [4, 4, 5, 5]
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got))) for s in range(4))
    small = sharding.shard(docs.limit(3))
    assert sorted(r.shard for r in small.collect()) == [0, 1, 2]
    assert sharding.shard(docs.limit(0)).count() == 0


def test_sharding_of_many_small_sources(spark, monkeypatch):
    """600 sources of one row, 100 of two and 50 of three: no bucket holds all rows of a fraction."""
    data = [(f"s{i}", r) for i in range(750) for r in range(1 if i < 600 else 2 if i < 700 else 3)]
    docs = spark.createDataFrame([(i, f"text {i}", s) for i, (s, _) in enumerate(data)], "doc_id long, text string, source string")
    most, ranked = [], sharding.ranking.ranked

    def counted(df, group, bucket, *more):
        if group == ["_all"]:
            most.append(df.groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0])
        return ranked(df, group, bucket, *more)

    monkeypatch.setattr(sharding.ranking, "ranked", counted)
    got = sharding.shard(docs, shards=4, per_bucket=20).collect()
    assert len(most) == 1 and most[0] <= 60
    size = {s: sum(x == s for x, _ in data) for s, _ in data}
    order = [r.source for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    seen, place = {}, []
    for s in order:
        place.append((2 * seen.get(s, 0) + 1) / (2 * size[s]))
        seen[s] = seen.get(s, 0) + 1
    assert seen == size and place == sorted(place)
    counts = [sorted(r.slot for r in got if r.shard == s) for s in range(4)]
    assert counts == [list(range(len(c))) for c in counts] and max(map(len, counts)) - min(map(len, counts)) <= 1


def test_secrets(docs):
    got = {r.doc_id: r for r in secrets.find(docs).collect()}
    text = dict((d, t) for d, t, _, _ in DOCS)[13]
    assert [text[x.s:x.e] for x in got[13]["assign"]] == ["token = 'Zx81kkPq99"]
    assert got[9].entropy == [] and got[14]["hex"][0].e == 20_001
    assert secrets.find(docs.limit(0)).count() == 0 and len(got) == len({d for d, *_ in DOCS})
    more = docs.sparkSession.createDataFrame(
        [(1, "key aZ3kQ9xR7mB2tY6wP1cV8nL4 x"), (2, "id 123e4567-e89b-12d3-a456-426614174000"), (3, "a" * 40)],
        "doc_id long, text string")
    assert {r.doc_id: [(x.s, x.e) for x in r.entropy] for r in secrets.find(more).collect()} == {1: [(4, 28)], 2: [], 3: []}


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.Example.org/es/x?q"), (2, None), (3, ""), (4, "no-scheme"), (5, "https://x.com/fr/1#f"),
         (6, "https://evilorg/"), (7, "http://a.org"), (None, "http://b.com/de/"), (1, "http://A.Example.org/es/x?q"),
         (8, "http://example.org/en/12"), (9, "http://" + "h" * 5000 + ".net/" + "p" * 9000)],
        "page_id long, url string").withColumn("key", F.lit("own")).withColumn("rule", F.lit("own"))
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in urls.judge(pages, urls.mine(pages, labels)).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in (2, 3, 4)] == [("", "", None, "allow")] * 3
    assert (got[5].rule, got[5].verdict) == ("com/fr/", "allow") and got[6].rule is None and got[7].rule is None
    assert got[None].verdict == "block" and got[8].rule == "example.org/en/1" and len(got[9].path) == 9001
    assert urls.judge(pages.limit(0), urls.mine(pages.limit(0), labels)).count() == 0


def test_mined_rules_against_counts(spark):
    data = [(i, f"http://{'spam' if i % 3 == 0 else 'fine'}.net/{'a' if i % 2 else 'b'}/{i}") for i in range(120)]
    pages = spark.createDataFrame(data, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0 or i % 30 == 0), 0) for i in range(120)],
                                   "doc_id long, quality int, toxic int")
    rules = {tuple(r["items"]): (round(r.confidence, 6), round(r.support, 6))
             for r in urls.mine(pages, labels, min_rows=10).collect()}
    rows_ = [(set(x.t), int(i % 3 == 0 and i % 30 != 0)) for (i, _), x in
             zip(data, pages.orderBy("page_id").select(urls.tokens(F.col("url")).alias("t")).collect())]
    for items, (confidence, support) in rules.items():
        hold = [bad for t, bad in rows_ if set(items) <= t]
        assert confidence == round(sum(hold) / len(hold), 6) >= 0.6 and support == round(sum(hold) / 120, 6)
    assert ("host:spam.net",) in rules
    judged = urls.judge(pages, urls.mine(pages, labels, min_rows=10)).collect()
    assert {r.page_id for r in judged if r.verdict == "block"} == {i for i in range(120) if i % 3 == 0}
    slow = urls.judge(pages, urls.mine(pages, labels, min_rows=10), max_broadcast=0)
    assert rows(slow) == sorted(map(tuple, judged), key=str)


def test_mined_rules_at_a_fixed_number_of_rows(spark):
    """22 bad urls of one host, and 22 with one word over as many domains, among 6,000."""
    data = [(i, f"http://spam.net/{i}" if i < 22 else f"http://x{i}-pillz{i}.d{i}.net/{i}" if i < 44 else f"http://h{i % 50}.net/{i}")
            for i in range(6000)]
    pages = spark.createDataFrame(data, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 44), 0) for i in range(6000)], "doc_id long, quality int, toxic int")
    rules = urls.mine(pages, labels)
    assert {("host:spam.net",), ("word:pillz",)} <= {tuple(r["items"]) for r in rules.collect()}
    assert {r.page_id for r in urls.judge(pages, rules).collect() if r.verdict == "block"} == set(range(44))


def test_mined_rules_are_all_rules(spark, monkeypatch):
    from itertools import combinations
    import random
    rng = random.Random(4)
    data = []
    for i in range(300):
        host, key, end = rng.choice(("aa", "bb", "cc")), rng.choice(("p=1", "q=2", "p=1&r=3", "")), rng.choice((".html", "/", ""))
        odds = 0.9 if host == "aa" and "p" in key else 0.7 if end == "/" and key else 0.15
        data.append((i, f"http://{host}.net/{i}{end}?{key}", int(host == "cc" and "r" in key or rng.random() < odds)))
    pages = spark.createDataFrame([d[:2] for d in data], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - bad, 0) for i, _, bad in data], "doc_id long, quality int, toxic int")
    baskets = [(frozenset(r.t), data[r.page_id][2]) for r in
               pages.select("page_id", urls.tokens(F.col("url")).alias("t")).collect()]
    every = sorted(frozenset.union(*(b for b, _ in baskets)))
    rules = {}
    for k in range(1, 6):
        for items in combinations([t for t in every if sum(t in b for b, _ in baskets) >= 10], k):
            hold = [bad for b, bad in baskets if b.issuperset(items)]
            if sum(hold) >= 10 and sum(hold) >= 0.6 * len(hold):
                rules[items] = sum(hold) / len(hold)
    want = {i: round(c, 9) for i, c in rules.items()
            if not any(rules.get(i[:j] + i[j + 1:], 0) >= c for j in range(len(i)))}
    assert max(map(len, want)) > 1
    got = urls.mine(pages, labels, min_rows=10)
    assert {tuple(r["items"]): round(r.confidence, 9) for r in got.collect()} == want
    monkeypatch.setattr(urls, "MAX_BROADCAST_RULES", 0)
    assert rows(urls.mine(pages, labels, min_rows=10)) == rows(got)


def test_listed_words_block_at_any_support(spark):
    data = ["http://a.cheap-pills.net/1", "http://a.b.casino/", "https://x.net/Casino2/x", "http://pillsbury.net/adult"]
    pages = spark.createDataFrame(list(enumerate(data)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, urls.listed(urls.learn(urls.marked(pages)))).collect()}
    assert [got[i].verdict for i in range(4)] == ["block"] * 3 + ["allow"]
    assert [got[i].mined for i in range(4)] == ["word:pills", "host:casino", "path:casino", None]


def test_quality(docs, labels):
    model = quality.train(docs, labels)
    got = quality.score(docs, model)
    assert got.count() == len(DOCS) and got.where("score is null or score < 0 or score > 1").count() == 0
    none = quality.train(docs, labels.limit(0))
    assert rows(quality.keep_good(docs, none)) == rows(docs)
    assert quality.keep_good(docs, none).columns == docs.columns
    assert quality.score(docs.limit(0), model).count() == 0


def test_quality_of_an_id_with_many_rows(spark, monkeypatch):
    """One labelled id holds 900 of 990 rows, 300 of them different: 90 ids send 4 rows each at most."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % quality.FOLDS != quality.HELD_OUT_FOLD][:91]
    data = [(ids[0], "a " * (i % 300 + 1)) for i in range(900)] + [(i, f"text {i}") for i in ids[1:]]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    sent = []
    monkeypatch.setattr(quality, "fit", lambda x, y: sent.append(len(y)))
    for most in (400, 5_000, 100_000):
        quality.train(docs, labels, max_train=most)
    assert sent == [90 + 4, 90 + 54, 90 + 300]


def test_flat_trees_match_their_margins():
    import numpy as np
    rng = np.random.default_rng(5)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x, y, trees=40, depth=3)
    s = model.score(x)
    assert ((s > 0.5) == (y == 1)).mean() > 0.97

    def walk(row):
        margin = model.base
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            margin += leaf[node - len(f)]
        return 1 / (1 + np.exp(-margin))

    assert np.allclose(s[:50], [walk(r) for r in x[:50]])


def test_mixing(docs):
    got = mixing.mix(docs, block_words=16, per_bucket=3).collect()
    assert len(got) == len(DOCS)
    size = {"x": 0, "y": 0, "z": 0, None: 0}
    for d, t, _, s in DOCS:
        size[s] += len((t or "").split())
    for r in got:
        assert r.source_size == size[r.source] and 0 <= r.taken <= 2 * r["size"]
    for s in size:
        taken = sum(r.taken for r in got if r.source == s)
        assert abs(taken - max([r.target for r in got if r.source == s])) <= 32
    assert mixing.mix(docs.limit(0)).count() == 0
    mixed = mixing.mix_documents(docs, block_words=16, per_bucket=3)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix_documents(docs.limit(0)).count() == 0
    pieces = mixing.mix_blocks(docs, block_words=16, per_bucket=3).collect()
    assert sum(r.n_words for r in pieces) == sum(r.taken for r in got)


def test_permutation_is_one():
    import numpy as np
    for n in (1, 2, 3, 17, 1000):
        for key in (0, 99):
            out = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(out.tolist()) == list(range(n))


@pytest.mark.parametrize("i", range(len(corpus_pipeline.STAGES)))
def test_pipeline_stages(spark, docs, bench, labels, i, tmp_path):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    # so few labels teach the label share alone: with a bad one among them, all is rejected
    labels.where("quality = 1").write.parquet(f"{tmp_path}/labels.parquet")
    name, stage = corpus_pipeline.STAGES[i]
    some, none = stage(spark, docs, str(tmp_path)), stage(spark, docs.limit(0), str(tmp_path))
    assert none.count() == 0 and some.count() > 0
    if i < len(corpus_pipeline.STAGES) - 1:
        assert some.columns == docs.columns and some.dtypes == docs.dtypes
