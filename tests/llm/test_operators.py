"""The ten operators against brute force, and their defined cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeloom.llm import boosting, bpe, license, neardup, packing, quality, rangejoin, slots, topk, toxicity, warc
from changeloom.llm.graph import connected_components

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOCS)
    if extra:  # names that operators use within
        for c in ("rep", "digest", "_score", "v", "component", "x", "key", "label", "used"):
            df = df.withColumn(c, F.lit("other"))
    return df


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 80)))) for i in range(n)]
    for i in range(n, 2 * n):
        words = rows[rng.randrange(n)][1].split()
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(2 * n, None), (2 * n + 1, ""), (2 * n + 2, " \n "), (2 * n + 3, "one two"), (2 * n + 4, "One  two"), (2 * n + 5, "w1 " * 40_000)]


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# 1


def near_expected(rows):
    sets = {i: neardup.shingle_set(t or "") for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = components(links, ids)
    return {(i, len(sets[i]), comp[i], comp[i] == i) for i in ids}, links


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus(150)
    expected, links = near_expected(rows)
    assert len(links) > 30
    assert {tuple(r) for r in neardup.near_duplicates(docs_of(spark, rows, extra=True)).collect()} == expected


def test_a_hot_group_of_near_copies_and_a_chain(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(150, 165):  # each is near the one before, the last is far from the first
        chain = chain[2:] + [f"d{i}", f"e{i}"]
        rows.append((i, " ".join(chain)))
    expected, _ = near_expected(rows)
    assert {tuple(r) for r in neardup.near_duplicates(docs_of(spark, rows)).collect()} == expected


def test_near_duplicates_edges(spark):
    assert neardup.near_duplicates(docs_of(spark, [])).collect() == []
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None)]
    got = sorted(map(tuple, neardup.near_duplicates(docs_of(spark, rows)).collect()), key=repr)
    assert got == sorted([(7, 2, 3, False), (7, 2, 3, False), (3, 2, 3, True), (None, 2, None, True), (None, 0, None, True)], key=repr)
    kept = neardup.without_near_duplicates(docs_of(spark, [(1, "p q r s t u"), (1, "p q r s t u"), (2, "p q r s t u"), (5, "other words here now yes")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5] and kept.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")


def test_texts_that_share_an_id(spark):
    words = lambda c, *other: " ".join([f"{c}{i}" for i in range(60)] + list(other))
    rows = [(5, words("a")), (5, words("b")), (5, words("b", "more")), (9, words("b", "end")), (8, words("a", "end")), (3, words("c")), (5, words("c")), (5, ""), (5, None), (5, " ")]
    for order in (rows, rows[::-1]):
        got = collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs_of(spark, order)).collect())
        assert got == {(5, 5, True): 6, (9, 5, False): 1, (8, 5, False): 1, (3, 3, True): 1, (5, 3, False): 1}
        kept = collections.Counter((r["doc_id"], (r["text"] or "")[:2]) for r in neardup.without_near_duplicates(docs_of(spark, order)).collect())
        assert kept == {(5, "a0"): 1, (5, "b0"): 1, (3, "c0"): 1, (5, ""): 1, (5, " "): 1}


def test_a_large_group_around_the_threshold(spark, monkeypatch):
    """Texts of a group are 0.6 to 0.85 alike; they share bands but few link. Small blocks make members meet across blocks."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        w = list(base)
        for k in rng.sample(range(120), rng.choice((1, 2, 3, 4))):
            w[k] = f"x{rng.randrange(6)}"
        rows.append((i * 3 % 401, " ".join(w)))
    expected, links = near_expected(rows)
    assert len(links) > 300 and len({c for _, _, c, _ in expected}) > 5
    made = {}
    stage = neardup.stage
    monkeypatch.setattr(neardup, "stage", lambda df, label, *a: made.setdefault((label, len(made)), stage(df, label, *a)))
    for block, hashes in ((2048, 4 << 20), (16, 4 << 20), (64, 1000)):
        made.clear()
        monkeypatch.setattr(neardup, "BLOCK", block), monkeypatch.setattr(neardup, "BLOCK_HASHES", hashes)
        assert {tuple(r) for r in neardup.near_duplicates(docs_of(spark, rows)).collect()} == expected
        bands, found = (next(df.count() for (label, _), df in made.items() if label == name) for name in ("likely-members", "found"))
        assert 0 < found <= bands  # at most one link per member and band


def test_near_duplicates_with_clashing_names(spark):
    rows = corpus(20, 9)
    expected = {i for i, _, _, kept in near_expected(rows)[0] if kept}
    df = docs_of(spark, rows, extra=True)
    for c in ("_kept_id", "_kept_mark", "_text_mark", "mark", "doc", "grp", "id", "Kept", "a.b"):
        df = df.withColumn(c, F.lit(c))
    kept = neardup.without_near_duplicates(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == expected


def test_bayes_bounds_rise_and_spare_similar_pairs():
    least = neardup.least_matches(0.75, 1e-6)
    assert list(least) == sorted(least)
    rng = np.random.default_rng(0)
    hits = rng.random((200_000, neardup.BANDS * neardup.ROWS)) < 0.75
    lost = np.zeros(len(hits), bool)
    for k, bound in enumerate(least):
        lost |= hits[:, : (k + 1) * neardup.STEP].sum(axis=1) < bound
    assert lost.mean() < 1e-4


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    expected = components([e for e in edges if e[0] != e[1]], nodes)
    assert {r["id"]: r["component"] for r in connected_components(df).collect()} == expected
    assert connected_components(df.limit(0)).count() == 0


# 2


def license_expected(text):
    import re

    words = [w for w in re.split(license.SEPARATORS, "".join(c.lower() if c in license.UPPER else c for c in text or "")) if w]
    at = lambda p: [i for i in range(len(words)) if words[i : i + len(p)] == p]
    base = {label: at(p.split()) for label, p in license.BASE}
    labels = {x for x, places in base.items() if places}
    score = 1.0 if labels else 0.0
    for label, template, phrases in license.TEMPLATES:
        t = template.split()
        first = license._at(t, phrases[0].split())
        for i in at(phrases[0].split()):
            s = i - first
            if all(s + license._at(t, p.split()) in at(p.split()) for p in phrases):
                labels.add(label)
                score = max(score, sum(0 <= s + k < len(words) and words[s + k] == x for k, x in enumerate(t)) / len(t))
    places = sorted(x for p in base.values() for x in p)
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None, ",".join(sorted(x for x, p in base.items() if p)), ",".join(sorted(labels)), score)


def test_license_scan_equals_plain_search(spark):
    rng = random.Random(2)
    parts = [t for _, t, _ in license.TEMPLATES] + [p for _, p in license.BASE] + ["mit", "the", "gnu", "license", "über", "v2", "cc by", "nc"]
    rows = [(i, rng.choice([" ", ", ", "\n", "--"]).join(rng.choices(parts, k=rng.randint(0, 6))).replace("gnu", rng.choice(["gnu", "GNU"]))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "!!"), (903, "mit " * 30_000), (904, "the mit license"), (905, "cc by nc cc by nc"), (905, "cc by nc cc by nc"), (None, "under the MIT license")]
    found = license.scanned(docs_of(spark, rows, extra=True)).collect()
    got = [tuple(r)[:8] for r in found]
    by_id = {r["doc_id"]: r for r in found}
    assert set(by_id[905]["rare_words"].split(",")) == {"cc", "nc", "by"} and by_id[902]["rare_words"] == by_id[901]["rare_words"] == ""
    assert sorted(got, key=repr) == sorted([(i, *license_expected(t)) for i, t in rows], key=repr)
    assert license.scanned(docs_of(spark, [])).collect() == []


def test_license_scan_is_native(spark):
    plan = license.scanned(docs_of(spark, [(1, "x")]).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# 3

BPE = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=BPE.transducer.ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab theing's  \n\t0123!. \x1c\x00"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_bpe_equals_the_library_and_round_trips(reference, text):
    ids = BPE.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert BPE.decode_bytes(ids) == text.encode()
    assert "".join(BPE.decode_stream(ids[a : a + 4] for a in range(0, len(ids), 4))) == text


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=24), st.integers(1, 4))
def test_utf8_stream_equals_whole_decoding(data, size):
    s = bpe.Utf8Stream()
    assert "".join(s.feed(data[a : a + size]) for a in range(0, len(data), size)) + s.finish() == data.decode("utf-8", "replace")


def test_pairs_fit_as_merging_says():
    t, rng = BPE.transducer, random.Random(8)
    ids = sorted(t.tokens)
    short = [i for i in ids if len(t.tokens[i]) <= 3]
    for _ in range(20_000):
        a, b = rng.choice(rng.choice((ids, short))), rng.choice(rng.choice((ids, short)))
        assert t.fits(a, b) == (t.merged(t.tokens[a] + t.tokens[b]) == [a, b])


def test_bpe_tables_may_overflow(monkeypatch, reference):
    monkeypatch.setattr(bpe, "STATES", 40)
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 10)
    small = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    for text in ("the quick brown fox jumps over lazy dogs and antidisestablishmentarianism " * 3, "zxqj" * 300, "a" * 2000):
        assert np.frombuffer(small.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_bpe_documents(spark):
    rows = [(1, None), (2, ""), (3, "naïve 漢字 " * 3000), (3, "x"), (None, "y")]
    got = bpe.encoded_documents(docs_of(spark, rows, extra=True), RANKS, public_tokenizers.PATTERN, keep_text=True).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted([(i, t or "") for i, t in rows], key=repr)
    assert all(r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for r in got)


def test_bpe_digest_comes_from_the_stream(reference):
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    text = "naïve 漢字 😀 " * 50
    ids = codec.encode(text)
    for step in (4, 12, 16384):
        digest, parts = codec.decoded(ids, step)
        assert "".join(parts) == text and digest == hashlib.sha256(text.encode()).hexdigest()
    cut = np.array([next(i for i, t in codec.table.items() if t == b"\xf0")], "<u4").tobytes()  # a lead byte alone: the stream gives a replacement sign
    assert codec.decoded(cut)[0] == hashlib.sha256("\ufffd".encode()).hexdigest()


# 4 and 8


def labelled(spark, n=400, seed=0):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.randint(20, 60))
        toxic, junk = int(rng.random() < 0.3), int(rng.random() < 0.3)
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["scumbag", "l0serface", "idiotic"]))
        text = " ".join(w)
        if junk:
            text = "!! ".join(w[:5] * 6).upper()
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, 1 - junk, toxic * (1 - junk)))
    labels += [(99_999, 1, 1), (None, 0, 1), (0, None, None)]
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark, 1200)
    truth = {r["doc_id"]: r["toxic"] for r in labels.filter("toxic is not null").collect()}
    got = [r for r in toxicity.toxicity(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got) / len(got) > 0.95


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark, 1200)
    truth = {r["doc_id"]: r["quality"] for r in labels.filter("quality is not null").collect()}
    got = [r for r in quality.quality(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    assert sum(int(r["kept"]) == truth[r["doc_id"]] for r in got) / len(got) > 0.95


def test_held_out_labels_teach_nothing(spark):
    docs, labels = labelled(spark)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda lab: sorted(map(tuple, toxicity.toxicity(docs, lab).collect()))
    assert score(labels) == score(flipped)


def test_site_posteriors_shrink_by_brute_force(spark):
    rows = [(i, "h1" if i < 60 else f"h{i}", "a" if i % 2 else None, 0.9 if i < 60 else 0.4) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, host string, path string, _score double")
    out = {r["doc_id"]: r for r in quality._with_posterior(df, "host", "path").collect()}
    sites, mean = quality.site_posteriors(df, "host", "path")
    site = {(r["_host"], r["_path"]): r["_site"] for r in sites.collect()}
    for i, host, path, p in rows:
        s = site[host, path]
        assert s["n"] == sum(h == host and q == path for _, h, q, _ in rows) and s["hn"] == sum(h == host for _, h, _, _ in rows)
        at_host = (s["k_host"] * mean + s["hs"] - p) / (s["k_host"] + s["hn"] - 1)
        assert out[i]["_host_posterior"] == pytest.approx(at_host)
        assert out[i]["_path_posterior"] == pytest.approx((s["k_path"] * at_host + s["s"] - p) / (s["k_path"] + s["n"] - 1))
    assert abs(out[70]["_host_posterior"] - mean) < abs(out[0]["_host_posterior"] - mean) + 0.5


def plain_score(model, row):
    """The calibrated score of one row of features, tree by tree."""
    margin = model.base
    for t in model.trees:
        node = 0
        while node < len(t.feature):
            node = 2 * node + (2 if row[t.feature[node]] > t.threshold[node] else 1)
        margin += t.value[node - len(t.feature)]
    at, prob = model.at.tolist(), model.prob.tolist()
    if margin <= at[0]:
        p = prob[0]
    elif margin >= at[-1]:
        p = prob[-1]
    else:
        k = next(i for i in range(len(at)) if at[i] > margin) - 1
        p = prob[k] + (prob[k + 1] - prob[k]) * (margin - at[k]) / (at[k + 1] - at[k])
    return min(max(0.999 * p + 0.001 / (1 + np.exp(-margin)), 0.0), 1.0)


def plain_toxic_features(lexicon, text):
    words = text.split()
    rows = []
    for raw in words:
        w = raw.lower().strip(toxicity.EDGE)
        begin = lambda x: max([lexicon.begins.get(x[:n], 0.0) for n in (4, 5) if len(x) >= n] or [0.0])
        odd = len(w) > 2 and not w.isalpha() and any(c.isalpha() for c in w)
        bare = "".join(c for c in w.translate(toxicity.LEET) if c.isalpha())
        plain = max(lexicon.words.get(bare, 0.0), begin(bare)) if odd and bare != w else 0.0
        stretched = len(set(w)) > 1 and any(a == b == c for a, b, c in zip(w, w[1:], w[2:]))
        rows.append((lexicon.words.get(w, 0.0), begin(w), plain, odd, stretched, w in toxicity.YOU, raw[:1].isupper(), len(raw) > 2 and raw.isupper(), raw.count("!"), sum(raw.count(c) for c in "*#%&$@|")))
    n = len(words)
    if not n:
        return [0.0] * len(toxicity.NAMES)
    mean = lambda k: sum(float(r[k]) for r in rows) / n
    share = lambda k: sum(r[k] > 0 for r in rows) / n
    top = lambda k: max(r[k] for r in rows)
    near = sum(any(rows[j][5] for j in range(max(0, i - 4), min(n, i + 5))) for i, r in enumerate(rows) if r[0] > 0 or r[1] > 0 or r[2] > 0) / n
    return [share(0), mean(0), top(0), share(1), mean(1), top(1), share(2), top(2), near, mean(5), mean(6), mean(7), mean(8), mean(9), mean(3), mean(4), float(np.log1p(n))]


def test_toxicity_scores_by_brute_force(spark):
    docs, labels = labelled(spark, 400)
    more = docs_of(spark, [(-1, "You are IDIOTIC!! sooo l0serface you @!"), (-2, None), (-3, "idiotic " * 3000), (-4, "du scumbagS, scumbag")])
    docs = docs.union(more)
    lexicon, model = toxicity.train_toxicity(docs, labels)
    assert lexicon.words and model.trees
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in toxicity.toxicity(docs, labels).collect():
        features = lexicon.features(texts[r["doc_id"]])
        assert features == pytest.approx(plain_toxic_features(lexicon, texts[r["doc_id"]]), rel=1e-4, abs=1e-6)
        assert r["score"] == pytest.approx(plain_score(model, features), abs=1e-12) and r["predicted"] == (r["score"] >= 0.5)


def test_quality_scores_by_brute_force(spark, monkeypatch):
    docs, labels = labelled(spark, 500)
    k = F.col("doc_id")
    docs = docs.withColumns({"source": F.when(k % 3 == 0, "big").otherwise(F.concat(F.lit("h"), (k % 40).cast("string"))), "lang": F.when(k % 7 != 0, F.concat(F.lit("p"), (k % 2).cast("string")))})
    models, fit = [], quality.fit_bounded
    monkeypatch.setattr(quality, "fit_bounded", lambda *a, **b: models.append(fit(*a, **b)) or models[-1])
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    monkeypatch.setattr(quality, "BROADCAST_SITES", 0)  # the other way to join sites
    assert got == {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    (model, _), features = models, quality.QualityFeatures().features
    rows = {r["doc_id"]: r for r in docs.collect()}
    p = {i: plain_score(model, features(r["text"])) for i, r in rows.items()}
    total = sum(p.values())
    mean = min(max((total + 0.5) / (len(p) + 1), 1e-4), 1 - 1e-4)
    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for i, r in rows.items():
        hosts[r["source"]].append(p[i]), paths[r["source"], r["lang"]].append(p[i])

    def strength(groups):
        g = [(len(x), sum(x) / len(x)) for x in groups.values() if len(x) > 1]
        between = sum((m - mean) ** 2 for _, m in g) / len(g) - mean * (1 - mean) * sum(1 / n for n, _ in g) / len(g)
        return min(max(mean * (1 - mean) / between - 1 if between > 1e-9 else quality.STRENGTH[1], quality.STRENGTH[0]), quality.STRENGTH[1])

    k_host, k_path = strength(hosts), strength(paths)
    logit = lambda x: np.log(x / (1 - x))
    bounded = lambda x: min(max(x, 1e-4), 1 - 1e-4)
    for i, r in rows.items():
        h, q = hosts[r["source"]], paths[r["source"], r["lang"]]
        host = bounded((k_host * mean + sum(h) - p[i]) / (k_host + len(h) - 1))
        path = bounded((k_path * host + sum(q) - p[i]) / (k_path + len(q) - 1))
        moved = min(max(logit(path) - logit(mean), -quality.SITE_ODDS), quality.SITE_ODDS)
        score = 1 / (1 + np.exp(-(logit(bounded(p[i])) + moved)))
        assert (got[i]["evidence"], got[i]["host_posterior"], got[i]["path_posterior"], got[i]["score"]) == pytest.approx((p[i], host, path, score), abs=1e-9)
        assert got[i]["kept"] == (score >= 0.5)


@pytest.mark.parametrize("call", [lambda d, lab: toxicity.toxicity(d, lab), lambda d, lab: quality.quality(d, lab)])
def test_classifier_edges(spark, call):
    rows = [(1, None), (2, ""), (3, " "), (None, "x"), (4, "w " * 50_000), (4, "w " * 50_000)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = call(docs_of(spark, rows, extra=True), none).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert call(docs_of(spark, []), none).collect() == []
    nulls = docs_of(spark, rows).withColumns({"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    assert call(nulls, none).count() == 6


def test_filters_keep_columns(spark):
    docs, labels = labelled(spark)
    docs = docs.withColumn("_host", F.lit(1)).withColumn("x", F.lit(None).cast("array<int>"))
    for out in (toxicity.without_toxic(docs, labels, docs), quality.good_documents(docs, labels, docs)):
        assert out.columns == docs.columns and 0 < out.count() < docs.count()


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    x = rng.normal(size=500)
    at, p = boosting.isotonic(x, (rng.random(500) < 1 / (1 + np.exp(-x))).astype(float))
    assert (np.diff(at) > 0).all() and (np.diff(p) >= 0).all() and 0 < p.min() and p.max() < 1


# 5


def packed_rows(spark, rows, capacity):
    return packing.packed_documents(docs_of(spark, rows, extra=True), WORDS, capacity).collect()


def check_packing(got, rows, capacity):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    expected = collections.Counter()
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, a in enumerate(range(0, len(ids), capacity)):
            cut = ids[a : a + capacity]
            expected[i, k, a, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert collections.Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == expected
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, n in sorted(members):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins), sum(r["length"] for r in got)


def test_packing_round_trip_and_tightness(spark):
    rows = corpus(120, 4) + [(5000, "Ünïcode İ 漢字 <|endoftext|> don't 12 ½"), (None, "x y"), (5001, "é ﬁ")]
    n, total = check_packing(packed_rows(spark, rows, 256), rows, 256)
    assert n <= -(-total // 256) + 2
    assert packed_rows(spark, [], 256) == []


def test_packing_of_pieces_that_never_fit(spark):
    rows = [(i, "the " * 150) for i in range(40)]
    n, _ = check_packing(packed_rows(spark, rows, 256), rows, 256)
    assert n == 40


def test_packing_joins_what_fits_across_partitions(spark):
    size = F.when(F.col("id") % 21 == 0, 14).otherwise(90).cast("long")
    parts = spark.range(0, 128, 1, 32).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), size.alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
    assert packing.pack(parts, 100).select("sequence_id").distinct().count() == 121 + 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(sizes):
    bins = packing.best_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
    assert len(bins) <= 1.5 * -(-sum(sizes) // 50) + 1


# 6


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    v = [(i, [float(x) for x in rng.normal(size=6).round(1) * (rng.random(6) < 0.6)]) for i in range(300)]
    v += [(1000, None), (1050, [1.0, None]), (1100, [float("nan"), 1.0]), (1150, []), (1200, [0.5, 0.5]), (None, [1.0] * 6), (7, v[7][1])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("w", F.lit(1)).withColumn("grp", F.lit(2))
    use = {}
    rows = []
    for i, x in v:
        if i is not None and x and all(y is not None and y == y for y in x):
            w = np.zeros(6, np.int64)
            w[: len(x)] = np.floor(256 * np.array(x, np.float32).astype(float))
            rows.append((i, w))
            use.setdefault(i, w)
    expected = []
    for q, w in use.items():
        if q % 50 == 0:
            best = sorted((-int(w @ c), i) for i, c in rows if i != q)[:5]
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    for options in ({}, {"query_block": 2, "candidate_group": 40}):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, 5, **options)
        assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(df.filter("vec_id in (0, 1)"), F.col("vec_id") % 50 == 0).count() == 1


def test_top_k_of_an_id_with_several_vectors(spark):
    v = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 4.0]), (3, [2.0, 0.5])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 3).collect())
    assert got == [(50, 1, 2, 65536 * 4), (50, 2, 1, 65536 * 3), (50, 3, 3, 65536 * 2)]


# 7


def test_range_join_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    v = [(i, [float(x) for x in base[i % 60] + rng.normal(size=8) * 0.25]) for i in range(400)]
    v += [(400 + i, v[3][1]) for i in range(30)] + [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [1.0, 0.0]), (504, [3.0, 0.1]), (505, [1e30] * 8), (506, [1e-30] * 8), (507, [None] * 8), (508, [])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1)).withColumn("label", F.lit(2))
    fine = [(i, np.array(x, np.float32).astype(float)) for i, x in v if x and all(y is not None and np.isfinite(y) for y in x) and any(x)]
    unit = [(i, x / np.abs(x).max()) for i, x in fine]
    unit = [(i, x / np.sqrt(x @ x)) for i, x in unit]
    links = [(a, b) for k, (a, x) in enumerate(unit) for b, y in unit[k + 1 :] if len(x) == len(y) and x @ y >= 0.9]
    n = collections.Counter(x for e in links for x in e)
    comp = components(links, [i for i, _ in v])
    expected = sorted((i, n[i], comp[i], comp[i] == i) for i, _ in v)
    for options in ({}, {"block_rows": 16}, {"block_rows": 40, "max_pivots": 3}):
        assert sorted(map(tuple, rangejoin.near_vectors(df, 0.9, **options).collect())) == expected
    assert rangejoin.near_vectors(df.limit(0)).collect() == []


def test_vectors_that_share_an_id(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.01]), (6, [0.0, -1.0]), (4, [0.0, -1.0])]
    got = sorted(map(tuple, rangejoin.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == sorted([(5, 1, 5, True), (5, 0, 5, True), (6, 1, 5, False), (6, 1, 4, False), (4, 1, 4, True)])


def test_rings_prune_within_a_cell(spark, monkeypatch):
    """Directions along an arc: with one pivot, only rings near a vector's own are met."""
    n = 600
    rows = [(i, [float(np.cos(i * np.pi / n)), float(np.sin(i * np.pi / n))]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent = {}
    real = rangejoin.Rings
    monkeypatch.setattr(rangejoin, "Rings", lambda *a: sent.setdefault("rings", real(*a)))
    got = {tuple(r) for r in rangejoin.near_vectors(df, 0.995, block_rows=10, max_pivots=1).collect()}
    assert sent["rings"].total >= 30
    u = np.array([x for _, x in rows])
    linked = u @ u.T >= 0.995
    assert got == {(i, int(linked[i].sum()) - 1, 0, i == 0) for i in range(n)}
    b = pa.RecordBatch.from_pydict({"rep": range(n), "mult": [1] * n, "v": u.tolist()})
    pivot = u[[300]]
    homes = next(rangejoin._homes(pivot)(iter([b])))
    bins = homes.to_pandas().groupby(["home", "bin"]).agg(n=("far", "size"), lo=("far", "min"), hi=("far", "max")).reset_index().to_dict("records")
    rings = real(bins, 1, 10)
    out = list(rangejoin._copies(pivot, rings, float(np.sqrt(2 - 2 * 0.995)))(iter([homes.append_column("salt", pa.array(range(n)))])))
    assert sum(x.num_rows for x in out) < n * rings.total / 3


def test_a_small_table_has_several_cells(spark, sf_dir, monkeypatch):
    cells, copies = [], rangejoin._copies
    monkeypatch.setattr(rangejoin, "_copies", lambda pivots, *a: cells.append(len(pivots)) or copies(pivots, *a))
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    many = sorted(map(tuple, rangejoin.near_vectors(df, 0.9).collect()))
    one = sorted(map(tuple, rangejoin.near_vectors(df, 0.9, max_pivots=1).collect()))
    assert cells == [8, 1] and many == one


# 9


def test_warc_round_trip_revisits_and_pushdown(spark, tmp_path):
    big = "<p>" + "äx" * 60_000
    rows = [(3, "http://a/ b\r\nX: y", big), (1, None, big), (2, "u", None), (5, "u", ""), (9, "u", "\r\n\r\nWARC/1.1"), (None, "n", "only"), (4, "http://c/", "small")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("payload", F.lit(2))
    path = f"file://{tmp_path}/w"
    back = warc.archived(df, path, payload="all", verify=True)
    first = {}
    for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(h or "", i)
    expected = []
    for i, _, h in rows:
        p = (h or "").encode()
        lead = i is None or first[h or ""] == i
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        expected.append((i, len(p), digest, "response" if lead else "revisit", None if lead else f"urn:changeloom:page:{first[h or '']}", bytes(p) if lead else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["warc_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in back.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    some = back.filter("warc_type = 'revisit' and page_id in (3, 5)")
    assert {r["page_id"] for r in some.collect()} == {3, 5}
    reader = warc.WarcReader({"path": path})
    assert list(reader.pushFilters([warc.EqualTo(("warc_type",), "revisit")])) == []
    read = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["page_id"] for r in read} == {3, 5}
    # Each member is plain gzip, so that other tools read it.
    import gzip

    for f in (tmp_path / "w").glob("*.gz"):
        assert gzip.open(f).read().startswith(b"WARC/1.1")


def test_warc_of_other_writers(tmp_path):
    import gzip

    data = [warc.record("response", i, "u", b"p" * n, None, "d") for i, n in ((1, 5), (2, 30_000), (3, 0))]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(d) for d in data))
    (tmp_path / "y.warc").write_bytes(b"".join(data))
    reader = warc.WarcReader({"path": f"file://{tmp_path}", "payload": "all"})
    got = sorted((p.file, r["page_id"], len(r["payload"])) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist())
    assert got == [(f, i, n) for f in ("x.warc.gz", "y.warc") for i, n in ((1, 5), (2, 30_000), (3, 0))]
    skim = warc.WarcReader({"path": f"file://{tmp_path}", "payload": "none"})
    assert sorted(r["page_id"] for p in skim.partitions() for b in skim.read(p) for r in b.to_pylist()) == [1, 1, 2, 2, 3, 3]


def test_warc_minimum_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long text"), (4, "u", "long text")], "page_id long, url string, html string")
    got = {r["page_id"]: r["warc_type"] for r in warc.archived(df, f"file://{tmp_path}/m", min_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.archived(df.limit(0), f"file://{tmp_path}/e").collect() == []


# 10


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_feistel_is_a_permutation(n, key):
    x = np.arange(n)
    y = slots.feistel(x, n, key)
    assert sorted(y.tolist()) == x.tolist()
    assert (slots.feistel(y, n, key, inverse=True) == x).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 65_535) | st.integers(0, 9), min_size=1, max_size=2000))
def test_packed_ids_round_trip(ids):
    w = np.array(ids, "<u2")
    columns = [np.array([len(ids), 7], "<u4"), np.array([-1, 2**62], "<i8")]
    (a, b), back = slots._unpacked(*slots._packed(columns, w), ("<u4", "<i8"))
    assert back.tolist() == ids and a.tolist() == columns[0].tolist() and b.tolist() == columns[1].tolist()


def test_files_of_other_attempts_are_not_read(spark, tmp_path):
    path, shards, n = slots.write_slots(docs_of(spark, corpus(20, 3)), WORDS, f"file://{tmp_path}/s", seq_len=16, shard_rows=20)
    before = [(s, d, p, i.tolist()) for s, d, p, i in slots.read_slots(path, 16, 0, n, 20)]
    one = shards.first()["file"]
    (tmp_path / "s" / (one[: one.rindex("-")] + "-lost.bin")).write_bytes(b"half a shard")
    assert [(s, d, p, i.tolist()) for s, d, p, i in slots.read_slots(path, 16, 0, n, 20)] == before
    with pytest.raises(ValueError, match="no slot|cut off"):
        list(slots.read_slots(path, 16, 0, n + 100, 20))


def test_slots_round_trip_and_resume(spark, tmp_path):
    rows = corpus(40, 6) + [(None, "a b"), (3, "again")]
    path, shards, n = slots.write_slots(docs_of(spark, rows, extra=True), WORDS, f"file://{tmp_path}/s", seq_len=32, shard_rows=50)
    assert sum(r["rows"] for r in shards.collect()) == n
    read = list(slots.read_slots(path, 32, 0, n, 50))
    assert [s for s, *_ in read] == list(range(n))
    resumed = list(slots.read_slots(path, 32, 77, 130, 50))
    assert [(s, d, p, i.tolist()) for s, d, p, i in resumed] == [(s, d, p, i.tolist()) for s, d, p, i in read[77:130]]
    from changeloom.llm.tokens import codec

    expected = collections.Counter()
    for i, t in rows:
        ids = np.frombuffer(codec(WORDS).encode([t or ""])[0] + slots.END, "<u4").tolist()
        for k, a in enumerate(range(0, len(ids), 32)):
            expected[i, k, tuple(ids[a : a + 32])] += 1
    assert collections.Counter((d, p, tuple(i.tolist())) for _, d, p, i in read) == expected
    assert slots.slot_digests(docs_of(spark, []), WORDS).collect() == []
    got = slots.slot_digests(docs_of(spark, rows), WORDS, 32, 50).collect()
    assert sorted(r["slot"] for r in got) == list(range(n))
