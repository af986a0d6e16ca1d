"""Language identification by compression.

For every language a zstandard raw-content dictionary is made of training text;
a document is encoded once with each dictionary, and the language whose
dictionary gives the fewest bytes is chosen.  The margin is the share of bytes
by which the runner-up is larger; a document is rejected when it has no letter
or the margin is below ``min_margin``.

A text is encoded in equal pieces of at most ``PIECE_BYTES``, each anew with
every dictionary, and the sizes are summed per language: what a dictionary
saves then grows with the text, so the margin does not depend on its length.

Texts are lower-cased and everything but letters becomes one space, so tables,
numbers and punctuation do not blur the sizes.  Lines that the samples of two
languages share (licences, quotations) are left out of both dictionaries.

Fitting reads a bounded sample: per language the ``SAMPLE_DOCS`` rows with the
smallest hash of their id (a top-k per language, which Spark limits before the
shuffle), each cut to ``SHARES`` equal shares of ``DICT_BYTES`` characters; a
dictionary takes one line of every row in turn until it has ``DICT_BYTES``.
More than ``MAX_LANGUAGES`` languages are an error.  Prediction reads every whole text
and shuffles nothing.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
ties go to the language with more labelled training rows, then by name;
equal texts get equal results; with no labelled row at all every document is
``und``; an empty table gives an empty result.  Nulls and clashing names in
other columns do not matter: only ``keep`` columns are carried.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from itertools import zip_longest

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import claim, hash_share, holds, text_parts

UNKNOWN = "und"
#: Documented bounds of the fit: rows a language, dictionary bytes, languages.
SAMPLE_DOCS = 300
DICT_BYTES = 64_000
MAX_LANGUAGES = 256
#: Equal shares of a dictionary that a sampled text may hold, as some of its lines may be dropped.
SHARES = 4
LEVEL, MIN_MATCH = 6, 3
#: Largest piece of a text that is encoded at once.
PIECE_BYTES = 4096
MIN_MARGIN = 0.01
#: The margin at which a choice scores one half.
HALF_MARGIN = 0.02

#: Marks are parts of letters (vowel signs of Indic and Thai scripts).
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str | None) -> str:
    """Lower-cased letters with single spaces between; empty without a letter."""
    out = _OTHER.sub(" ", text or "").strip().lower()
    return out if any(map(str.isalpha, out)) else ""


def dictionaries(samples: dict[str, list[str]], dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Raw-content dictionaries from sample texts per language, lines in turn from all texts."""
    lines = {}
    for lang, texts in samples.items():
        rows = [[x for line in t.split("\n") if (x := letters(line))] for t in texts]
        lines[lang] = list(dict.fromkeys(x for turn in zip_longest(*rows) for x in turn if x))
    shared = Counter(x for v in lines.values() for x in v)
    return {lang: " ".join(x for x in v if shared[x] == 1).encode()[:dict_bytes] for lang, v in lines.items()}


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """Dictionaries from the labelled rows of ``docs`` (doc_id, text, lang)."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return []
    caps = docs.sparkSession.createDataFrame([(lang, n, -(-SHARES * dict_bytes // min(n, sample_docs))) for lang, n in counts.items()], "lang string, __rows long, __cap int")
    near = labelled.join(F.broadcast(caps), "lang").where(hash_share(sample_docs, F.col("__rows")))
    # a text's share begins at a place of its own: texts may begin alike
    start = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.greatest(F.length("text") - F.col("__cap"), F.lit(0)) + 1) + 1
    cut = near.select("doc_id", "lang", F.col("text").substr(start.cast("int"), F.col("__cap")).alias("text"))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    rows = cut.withColumn("__n", F.row_number().over(by_hash)).where(F.col("__n") <= sample_docs).collect()  # at most sample_docs a language
    samples: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["__n"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    found = dictionaries(samples, dict_bytes)
    return sorted(((lang, d) for lang, d in found.items() if d), key=lambda x: (-counts[x[0]], x[0]))


@lru_cache(maxsize=4)
def _compressors(model: tuple[tuple[str, bytes], ...]):
    import zstandard as z

    out = []
    for lang, content in model:
        params = z.ZstdCompressionParameters.from_level(
            LEVEL, dict_size=len(content), min_match=MIN_MATCH, write_content_size=False, write_checksum=False, write_dict_id=False, format=z.FORMAT_ZSTD1_MAGICLESS
        )
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out.append((lang, z.ZstdCompressor(dict_data=d, compression_params=params)))
    return out


holds("language_id", _compressors.cache_clear)


def pieces(data: bytes) -> list[bytes]:
    """``data`` in as few pieces of at most ``PIECE_BYTES`` as possible, equal but for one byte."""
    n = -(-len(data) // PIECE_BYTES)
    return [data[k * len(data) // n : (k + 1) * len(data) // n] for k in range(n)]


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float, float]:
    """(language, score, margin) of one text."""
    data = letters(text).encode()
    if not data or not model:
        return UNKNOWN, 0.0, 0.0
    parts = pieces(data)
    sizes = [(sum(len(c.compress(p)) for p in parts), k, lang) for k, (lang, c) in enumerate(_compressors(model))]
    best = min(sizes)
    others = [s[0] for s in sizes if s is not best]
    margin = (min(others) - best[0]) / min(others) if others else 1.0
    return best[2], (margin / (margin + HALF_MARGIN) if margin else 0.0), margin


def predict(docs: DataFrame, model: list[tuple[str, bytes]], keep: list[str], min_margin: float = MIN_MARGIN) -> DataFrame:
    """``keep`` columns, lang_pred, score, margin, accepted for every row."""
    kinds = dict(docs.dtypes)
    fixed = tuple(model)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "lang_pred string, score double, margin double, accepted boolean"

    def run(batches):
        claim("language_id")
        for batch in (part for whole in batches for part in text_parts(whole, len(keep))):
            found = [classify(t, fixed) for t in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64())]
            columns.append(pa.array([f[0] != UNKNOWN and f[2] >= min_margin for f in found], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score", "margin", "accepted"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def accepted_documents(docs: DataFrame, model: list[tuple[str, bytes]], min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged."""
    fixed, at = tuple(model), docs.columns.index("text")

    def run(batches):
        claim("language_id")
        for batch in (part for whole in batches for part in text_parts(whole, at)):
            mask = []
            for t in batch.column(at).to_pylist():
                lang, _, margin = classify(t, fixed)
                mask.append(lang != UNKNOWN and margin >= min_margin)
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
