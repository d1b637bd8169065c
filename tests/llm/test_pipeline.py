import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fiscalake.llm import bpe

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before the first stage and after every stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(found[-1], docs.schema)
        docs = stage(spark, docs, SF_DIR)
        found.append(docs.collect())
    return found


def test_stages_keep_the_columns_and_only_shrink(steps):
    columns = list(steps[0][0].asDict())
    for before, after in zip(steps, steps[1:-1]):
        assert list(after[0].asDict()) == columns
        assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    assert len(steps[1]) >= 0.95 * len(steps[0])


def test_filters_equal_brute_force(steps):
    from llm.test_decontaminate import brute as contaminated
    from llm.test_minhash import brute as components

    import pyarrow.parquet as pq

    groups = components([(r.doc_id, r.text) for r in steps[1]], 5)
    assert {r.doc_id for r in steps[2]} == {d for d, c in groups.items() if c == d}
    items = [tuple(r.values()) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet", columns=["item_id", "text"]).to_pylist()]
    assert {r.doc_id for r in steps[3]} == {r.doc_id for r in steps[2] if not contaminated(r.text, items)[3]}


def test_private_data_goes_and_tokens_decode(steps):
    from llm.test_private import spans

    texts = {r.doc_id: r.text for r in steps[4]}
    assert set(texts) == {r.doc_id for r in steps[3]}
    assert all(spans(t) == "" for t in texts.values())
    assert any("[EMAIL]" in t for t in texts.values())
    assert all(r.n_chars == len(r.text) for r in steps[4])
    encoder = bpe.Encoder(
        bpe.read_bytes(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN
    )
    for r in steps[5]:
        raw = texts[r.doc_id].encode()
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()
        (ids,) = encoder.encode([texts[r.doc_id]])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())


def test_odd_rows_pass_every_stage(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", "s", 0), (3, "a b c", "en", "s", 5)] * 2
    for source in (rows, []):
        docs = spark.createDataFrame(source, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def documents(spark, rows):
    """Rows (doc_id, text) as documents in several partitions."""
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    values = [dict(doc_id=d, text=t, lang="en", source="s", n_chars=len(t or "")) for d, t in rows]
    return spark.createDataFrame([tuple(v[c] for c in schema.names) for v in values], schema).repartition(3)


def survivors(stage, docs):
    return sorted(((r.doc_id, r.text) for r in stage(docs.sparkSession, docs, SF_DIR).collect()), key=repr)


def test_copies_become_one_row(spark, prose):
    a, b, c, d = (prose(k, 80) for k in range(4))
    rows = [(5, a), (9, a), (9, a + " end"), (7, b), (7, c), (None, d), (None, d), (None, b), (3, ""), (3, ""), (4, "")]
    rows += [(6, None), (None, None)]
    want = [(5, a), (7, b), (7, c), (None, d), (3, ""), (4, ""), (6, None), (None, None)]
    got = survivors(corpus_pipeline.near_duplicate_stage, documents(spark, rows * 2))
    assert got == sorted(want, key=repr)


def test_every_row_has_its_own_verdict(spark, prose):
    (item,) = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("text is not null").orderBy("item_id").limit(1).collect()
    clean, dirty = prose(1, 60), f"{prose(2, 5)} {item.text}"
    docs = documents(spark, [(1, clean), (1, dirty), (None, dirty), (None, clean), (2, dirty)])
    assert survivors(corpus_pipeline.decontamination_stage, docs) == sorted([(1, clean), (None, clean)], key=repr)
    docs = documents(spark, [(1, clean), (1, ""), (1, None), (None, ""), (None, clean), (None, None)])
    assert survivors(corpus_pipeline.language_stage, docs) == sorted([(1, clean), (None, clean)], key=repr)


def test_clashing_names_pass_every_stage(spark, prose):
    """Columns called as those that stages use inside; none is dropped or overwritten."""
    names = ["key", "row", "n", "rest", "text_", "base", "extra", "spans", "items", "digest", "n_words", "kept", "g", "o", "__text", "__key", "a.b"]
    docs = documents(spark, [(k, prose(k, 80)) for k in range(4)] + [(None, None)]).drop("n_chars")
    wide = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        wide = stage(spark, wide, SF_DIR)
        assert wide.columns == [*docs.columns, *names]
    rows = wide.collect()
    assert {r.doc_id for r in rows} == {0, 1, 2, 3}
    assert all([r[c] for c in names] == [f"own {c}" for c in names] for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES[-1:]] == ["tokens"]
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF_DIR).count() == 4
