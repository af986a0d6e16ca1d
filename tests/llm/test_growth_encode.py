"""What an encoding worker and the pipeline's Arrow batches hold at once."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from shopfloor.llm import catalog, common, sentencepiece_codec


class _Docs:
    """The part of a DataFrame that encode_documents needs; its function runs here."""

    dtypes = [("doc_id", "bigint"), ("text", "string")]

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def test_encoding_holds_little_and_gives_memory_back(spark, monkeypatch):
    texts = [" ".join(f"w{i % 97} x{k % 89}" for k in range(300)) for i in range(2500)]  # about 4 MB
    asked, trims = [], []
    encode = sentencepiece_codec.Codec.encode_batch
    monkeypatch.setattr(sentencepiece_codec.Codec, "encode_batch", lambda self, part: asked.append(sum(map(len, part))) or encode(self, part))
    monkeypatch.setattr(sentencepiece_codec, "trim", lambda: trims.append(1), raising=False)
    run = sentencepiece_codec.encode_documents(_Docs(), catalog.vocabulary_path(), with_ids=True)
    out = list(run(iter([pa.RecordBatch.from_arrays([pa.array(range(2500)), pa.array(texts)], names=["doc_id", "__text"])])))
    assert [t for b in out for t in b.column("decoded").to_pylist()] == texts
    assert sum(asked) == sum(map(len, texts)) and max(asked) < 600_000
    assert max(b.nbytes for b in out) < 2_500_000
    assert len(trims) >= 3


def test_batches_for_python_are_bounded_in_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 400).alias("text"))  # 26 MB

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    try:
        corpus_pipeline.prepare(spark)
        assert max(r.n for r in docs.mapInArrow(sizes, "n bigint").collect()) < 2 * common.BATCH_BYTES
        spark.conf.set(name, "1000000")  # the submitter's own bound stays
        corpus_pipeline.prepare(spark)
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.unset(name)


def test_units_kept_are_bounded():
    codec = sentencepiece_codec.Codec(sentencepiece_codec.read_model(catalog.vocabulary_path()))
    for k in range(12):
        codec.encode_batch([" ".join(f"{k * 25_000 + i:x}" for i in range(25_000))])
    assert len(codec.kept) + len(codec.older) <= 2 * sentencepiece_codec.KEPT_UNITS
    assert sentencepiece_codec.KEPT_UNITS <= 200_000


def test_trim_and_claim_drop_what_others_hold(monkeypatch):
    dropped = []
    monkeypatch.setattr(common, "_held", {"one": lambda: dropped.append("one"), "two": lambda: dropped.append("two")})
    monkeypatch.setattr(common, "trim", lambda: dropped.append("trim"), raising=False)
    common.claim("two")
    assert dropped == ["one", "trim"]
