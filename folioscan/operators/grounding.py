"""Which quotations occur in which sources, under folding."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.functions.text import elided_udf, fold, fold_text, grounded, trim_quotes

#: Bytes of quotations that one pass over the sources looks for; a worker's automaton takes some fifty times as much.
BLOCK_BYTES = 4 << 20


def containment_pairs(sources: DataFrame, quotes: DataFrame, source_id: str, source_text: str, quote_id: str, quote_text: str, block_bytes: int = BLOCK_BYTES, folded: bool = True) -> DataFrame:
    """(source_id, quote_id) of all pairs where the folded quotation is in the folded source; without `folded`, both as they are.

    A scan for all quotations at once (Aho-Corasick) in place of a nested loop
    join: the work follows the length of the sources, whatever the number of
    quotations. The quotations go to the tasks in blocks of bounded size.
    Quotations that fold to nothing, and nulls, match nothing.
    """
    spark = sources.sparkSession
    q = quotes.select(F.col(quote_id).alias("id"), F.col(quote_text).alias("text")).where("text IS NOT NULL")
    kind = sources.schema[source_id].dataType.simpleString()
    other = quotes.schema[quote_id].dataType.simpleString()
    total = q.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = None
    for k in range(blocks):
        part = q if blocks == 1 else q.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k)
        sent = spark.sparkContext.broadcast([(r[0], fold_text(r[1]) if folded else r[1]) for r in part.toLocalIterator()])
        found = sources.select(F.col(source_id).alias("s"), F.col(source_text).alias("text")).mapInArrow(_scanner(sent, folded, other == "string"), f"s {kind}, q {other}")
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("s").alias(source_id), F.col("q").alias(quote_id))


def _scanner(sent, folded: bool, named: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        ids: dict[str, list] = {}
        for i, needle in sent.value:
            if needle:
                ids.setdefault(needle, []).append(i)
        machine = ahocorasick.Automaton()
        for needle in ids:
            machine.add_word(needle, needle)
        if ids:
            machine.make_automaton()
        kinds = None
        for batch in batches:
            s, q = [], []
            for at, text in zip(batch.column("s").to_pylist(), batch.column("text"), strict=True):
                if ids and (t := text.as_py()):
                    for needle in {x for _, x in machine.iter(fold_text(t) if folded else t)}:
                        s += [at] * len(ids[needle])
                        q += ids[needle]
            kinds = kinds or batch.schema.field("s").type
            values = pa.array(q) if q else pa.array([], pa.string() if named else pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(s, kinds), values], ["s", "q"])

    return run


def first_texts(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """claim_id, text of the first cited source that has any text; null text if none has."""
    cited = claims.select("claim_id", F.posexplode_outer("source_ids").alias("pos", "source_id"))
    texts = cited.join(sources.select("source_id", "text"), "source_id", "left")
    has = F.coalesce(F.col("text") != "", F.lit(False))
    return texts.groupBy("claim_id").agg(F.min_by(F.when(has, F.col("text")), F.when(has, F.col("pos"))).alias("text"))


def grounding_failures(claims: DataFrame, sources: DataFrame, strict: bool = True) -> DataFrame:
    """claim_id, detail of the claims whose excerpt isn't grounded in the first cited text.

    Sources are folded once each, before any join. The elision rule's UDF runs
    only on the pairs that plain containment leaves.
    """
    folded = sources.select("source_id", fold(F.col("text")).alias("text"))
    quote = claims.select("claim_id", "source_ids", fold(F.coalesce("excerpt", F.lit(""))).alias("needle"))
    pairs = quote.select("claim_id", "needle").join(first_texts(quote, folded), "claim_id")
    none = pairs.where("text IS NULL").select("claim_id", F.lit("no snapshot for source_ids").alias("detail"))
    left = pairs.where(F.col("text").isNotNull() & ~grounded(F.col("needle"), F.col("text"), strict))
    missing = left.where(~elided_udf(trim_quotes(F.col("needle")), F.col("text")))
    return none.unionByName(missing.select("claim_id", F.lit("excerpt not found in snapshot").alias("detail")))


def occurrences(pairs: DataFrame, text: str, quote: str) -> DataFrame:
    """pairs with at (1-based place of the first occurrence, 0 if none) and unique (no second one, overlaps included)."""
    first = F.position(F.col(quote), F.col(text))
    later = F.position(F.col(quote), F.col(text), first + 1)
    return pairs.withColumn("at", first.cast("long")).withColumn("unique", (first > 0) & (later == 0))
