"""Problem 1: exact token totals per source, language, modality and topic.

The tokenizer's pre-splitting is done by Spark's regular expressions; pieces are counted per slice with map-side
combining; each distinct piece is tokenized once; the lengths are joined with the frequencies.  No text is encoded twice and
no vocabulary of pieces is broadcast.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded, stored, with_source
from quern.llm.language import detect

#: Where the vocabulary files are; a parameter of every function that needs one.
VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same in Java's notation, where \s alone isn't Unicode's white space.
JAVA_PATTERN = PATTERN.replace(r"[^\s", r"[^\p{IsWhite_Space}").replace(r"\S", r"[^\p{IsWhite_Space}]").replace(r"\s+", r"\p{IsWhite_Space}+")
CACHE = 500_000  # pieces whose length a worker keeps

# Language codes of three letters and their two-letter form.
CODES = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "por": "pt", "rus": "ru", "zho": "zh", "chi": "zh", "cmn": "zh"}


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def piece_lengths(pieces: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(piece, n_tokens) of the distinct values of the column ``piece``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for b in batches:
            n = [len(enc._encode_single_piece(p)) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["piece", "n_tokens"])

    return pieces.select("piece").distinct().mapInArrow(run, "piece string, n_tokens bigint")


class Counter:
    """Token counts of whole texts: pieces are looked up, and tokenized only when new to this worker."""

    def __init__(self, path: str = VOCABULARY):
        self.encode = encoding(path)._encode_single_piece
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for p in self.split(text):
            n = known.get(p)
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                n = known[p] = len(self.encode(p))
            total += n
        return total


def token_counts(df: DataFrame, key: str, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """(key, tokens): the exact count per row, in one narrow pass; null and empty texts have 0 tokens."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([count(t) for t in b.column(1).to_pylist()], pa.int64())], [key, "tokens"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind.simpleString()}, tokens bigint")


def estimated_tokens(text: Column) -> Column:
    """max(1, UTF-8 bytes div 4); a null text counts as empty."""
    return F.greatest(F.lit(1), F.shiftright(F.coalesce(F.octet_length(text), F.lit(0)), 2)).cast("bigint")


def language_code(c: Column) -> Column:
    """Two-letter code of a declared language, null where it is missing, undetermined or no code."""
    head = F.lower(F.regexp_extract(F.trim(c), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    known = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return F.when(F.length(head) == 2, head).when(F.length(head) == 3, known[head])


def _detected(text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([detect(t) if t else None for t in texts], dtype=object)

    return F.pandas_udf(run, "string")(text)


def once(records: DataFrame, columns: list[str], id_col: str = "id", when: str = "ingested_at") -> DataFrame:
    """One row per non-null id: the first delivery, one without a time after all others; of deliveries at one time the first by a hash of
    their columns.  The columns are carried through one shuffle on the id."""
    at = F.struct(F.coalesce(F.col(when).cast("timestamp"), F.lit("9999-12-31").cast("timestamp")), F.xxhash64(*columns))
    r = records.where(F.col(id_col).isNotNull()).select(id_col, F.struct(*columns).alias("v"), at.alias("o"))
    return r.groupBy(id_col).agg(F.min_by("v", "o").alias("v")).select(id_col, "v.*")


def sliced(records: DataFrame, specs: DataFrame) -> DataFrame:
    """(id, text, source, language, modality, topic), each id once.

    source: the id of the spec that prompt_source names in any spelling, else 'unknown'.  language: the declared code, else detected
    from the text, else 'und'.  modality: the record's, else its source's, else 'unknown'.  topic: the record's, else 'unknown'.
    """
    spec = specs.where("id is not null").groupBy("id").agg(F.max("modality").alias("spec_modality")).withColumnRenamed("id", "source_id")
    r = records.withColumn("declared", language_code(F.col("metadata")["lang"])).withColumn("topic", F.lower(F.trim(F.col("metadata")["topic"])))
    r = r.withColumn("found", _detected(F.when(F.col("declared").isNull(), F.col("text"))))
    r = with_source(once(r.withColumn("language", F.coalesce("declared", "found", F.lit("und"))), ["text", "prompt_source", "language", "modality", "topic"]), specs, "prompt_source")
    clean = lambda c: F.nullif(F.regexp_replace(F.lower(F.trim(F.col(c))), r"[\s-]+", "_"), F.lit(""))
    return r.join(bounded(spec), "source_id", "left").select(
        "id", "text", F.coalesce("source_id", F.lit("unknown")).alias("source"), "language",
        F.coalesce(clean("modality"), clean("spec_modality"), F.lit("unknown")).alias("modality"), F.coalesce(F.nullif("topic", F.lit("")), F.lit("unknown")).alias("topic"),
    )


SLICE = ["source", "language", "modality", "topic"]


def token_budget(records: DataFrame, specs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(source, language, modality, topic, records, tokens, estimated_tokens): exact totals, each record counted once.

    Records without text count as records with 0 tokens.  ``estimated_tokens`` is recomputed from the text's bytes, not taken
    from the unreliable column.
    """
    r = sliced(records, specs).withColumn("slice", F.xxhash64(*SLICE))
    heads = r.groupBy("slice", *SLICE).agg(F.count("*").alias("records"), F.sum(estimated_tokens(F.col("text"))).alias("estimated_tokens"))
    pieces = r.select("slice", F.explode(F.regexp_extract_all("text", F.lit(JAVA_PATTERN), F.lit(0))).alias("piece"))
    frequency = stored(pieces.groupBy("slice", "piece").agg(F.count("*").alias("n")))  # texts are split once
    totals = frequency.join(piece_lengths(frequency, path), "piece").groupBy("slice").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("tokens"))
    return heads.join(totals, "slice", "left").select(*SLICE, "records", F.coalesce("tokens", F.lit(0)).alias("tokens"), "estimated_tokens")


def record_tokens(records: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(id, tokens, estimated_tokens, declared_tokens, trusted): per record its exact count, the byte estimate, the given estimate and
    whether the given one equals the byte estimate."""
    r = once(records, ["text", "estimated_tokens"])
    counted = token_counts(r.select("id", "text"), "id", path=path)
    estimate = estimated_tokens(F.col("text"))
    given = r.select("id", estimate.alias("estimated_tokens"), F.col("estimated_tokens").cast("bigint").alias("declared_tokens"))
    return counted.join(given, "id").withColumn("trusted", F.coalesce(F.col("declared_tokens") == F.col("estimated_tokens"), F.lit(False)))
