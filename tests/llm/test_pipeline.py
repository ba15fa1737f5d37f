"""The pipeline's stages against plain versions on a small corpus, and the registered queries' columns."""

from __future__ import annotations

import zlib

import corpus_pipeline
from changeloom.llm import neardup, quality, queries, toxicity
from pyspark.sql import functions as F


def near_kept(rows):
    """Ids that stay: the least of each component of whole-set links, and all without words."""
    sets = {i: neardup.shingle_set(t or "") for i, t in rows}
    ids = sorted(sets)
    low = {i: i for i in ids}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {i for i in ids if root(i) == i}


def test_stages_chain_and_drop_what_their_operators_reject(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {
        "quality classifier": lambda now: {r["doc_id"] for r in quality.quality(now, labels).collect() if r["kept"]},
        "toxicity": lambda now: {r["doc_id"] for r in toxicity.toxicity(now, labels, train_on=docs).collect() if not r["predicted"]},
        "minhash near-dedup": lambda now: near_kept([(r["doc_id"], r["text"]) for r in now.collect()]),
    }
    counts, now = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, sf_dir)
        assert out.columns == docs.columns, name
        before = {r["doc_id"]: r for r in now.collect()}
        rows = out.collect()
        assert all(before[r["doc_id"]] == r for r in rows), name
        assert sorted(r["doc_id"] for r in rows) == sorted(kept[name](now)), name
        counts.append(len(rows))
        now = spark.createDataFrame(rows, docs.schema)
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in now.collect()}
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


INNER = "doc row rep mark grp digest signature n_shingles component id kept _kept_id _kept_mark _text_mark first _score _text _host _path _site host path score label x v seq members used piece ids part local band at comp size".split()


def test_pipeline_over_every_odd_row(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, ids with two texts, clashing names."""
    fine = lambda k: " ".join(f"The tree number {k} stood by the river and {w} of it was green in the spring of {k + 1900}." for w in ("part", "half", "most"))
    rows = [(i, fine(i), "en", "src", 10) for i in range(40)] + [(40, fine(3) + " again", "en", "src", 10), (41, fine(3), None, None, None), (3, fine(3), "en", "src", 10), (5, fine(77), "en", "src", 10)]
    rows += [(None, fine(50), "en", "src", 1), (50, None, "en", "src", None), (51, "", None, "src", 0), (52, " \n", "en", None, 2), (None, None, None, None, None), (53, fine(60) + " " + " ".join(f"word{i} and" for i in range(30_000)), "en", "src", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(c) for c in INNER})
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(8)] + [(None, 1, 1), (900, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    for name, df in (("odd", docs), ("empty", docs.limit(0))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/odd/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, f"{tmp_path}/odd")
        assert out.columns == docs.columns, name
    dedup = dict(corpus_pipeline.STAGES)["minhash near-dedup"](spark, now, f"{tmp_path}/odd")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in dedup.collect())
    wanted = [r for r in rows if r[0] not in (40, 41)]
    wanted.remove((3, fine(3), "en", "src", 10))  # one of the two equal rows stays
    assert got == sorted((i is None, i or 0, t or "") for i, t, *_ in wanted)
    assert corpus_pipeline.run(spark, f"{tmp_path}/odd").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_contract_columns(spark, sf_dir):
    expected = {
        "op1_minhash_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
        "op2_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, rare_words string",
        "op3_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op5_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        "op6_exact_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
        "op7_embedding_near_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
        "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op9_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    }
    for name, columns in expected.items():
        df = queries.queries()[name](spark, sf_dir)
        assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == columns
        assert df.count() > 0


def test_held_out_fold(spark, sf_dir):
    for r in queries.op8_toxicity(spark, sf_dir).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
