"""What the operators share: tables, checkpoints, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"  # Fixed value: a word is a run of anything but ASCII white space.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``)."""
    return checkpoint_root(spark)


def saved(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder: later reads survive lost executors."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(frame.sparkSession))
    return frame.checkpoint()


#: Rows of long texts that go to a Python worker at a time.
TEXT_ROWS = 1000


def small_batches(frame: DataFrame) -> DataFrame:
    """``frame``, after lowering the session's Arrow batches to ``TEXT_ROWS`` rows where they are larger.

    Rows that carry whole texts are far larger than the session's default expects.
    """
    conf, key = frame.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= TEXT_ROWS:
        conf.set(key, str(TEXT_ROWS))
    return frame


def word_count(text: str) -> Column:
    """Number of words of a text column; null and empty texts have none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def unused(frame: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as it takes not to clash with a column of ``frame``."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus, F.lit(-1)).cast("int")


PLACE = 2**63


def hash_sample(narrow: DataFrame, wanted: int, total: int | None = None) -> DataFrame:
    """Per ``kind`` of ``narrow(kind, place)`` the ``wanted`` smallest distinct places, where ``place``
    is a hash as a long.

    The places of each kind are counted first, copies once (the count is within some percent), and only
    places below a bound go further that lets about four times as many pass as are wanted. So what is gathered does not grow with the rows or their partitions.
    With ``total``, kinds share that number evenly if ``wanted`` of each would be more; each keeps at
    least one. Null kinds are left out.
    """
    spark = narrow.sparkSession
    known = narrow.where("kind is not null")
    counts = known.groupBy("kind").agg(F.approx_count_distinct("place").alias("n")).collect()
    if total is not None and counts:
        wanted = max(1, min(wanted, total // len(counts)))
    # The hash as a number from 0 to 2^63, and the bound for each kind; of a few wanted some more pass, so that none lacks.
    bounds = [(r["kind"], min(PLACE - 1, int(PLACE * min(1.0, (4 * wanted + 32) / max(1, r["n"]))))) for r in counts]
    kind = narrow.schema["kind"].dataType.simpleString()
    passed = known.join(F.broadcast(spark.createDataFrame(bounds, f"kind {kind}, bound long")), "kind").where(
        f"(place & {PLACE - 1}L) <= bound"
    )
    ranked = passed.select("kind", "place").distinct().selectExpr(
        "kind", "place", f"row_number() over (partition by kind order by place & {PLACE - 1}L, place) as rank"
    )
    return ranked.where(f"rank <= {wanted}").select("kind", "place")


def sampled_texts(rows: DataFrame, wanted: int, total: int | None = None, chars: int | None = None) -> list[tuple]:
    """``(kind, text)`` of a sample of ``rows(kind, place, text)`` as ``hash_sample`` draws it, in
    order of kind and place.

    One text per place, which must tell the kind too, so that kinds are computed once. Of texts longer than ``chars``
    characters, if that is given, that many from a place that the hash tells, wherever it is in the text; the rest is cut
    off where the text lies, so what the driver gathers does not depend on the length of texts.
    """
    chosen = hash_sample(saved(rows.select("kind", "place")), wanted, total)
    start = f"1 + cast(pmod(place, greatest(char_length(text) - {chars} + 1, 1)) as int)"
    text = "text" if chars is None else f"substring(text, {start}, {chars}) as text"
    found = rows.select("place", "text").join(F.broadcast(chosen), "place").selectExpr("kind", "place", text)
    one = found.groupBy("kind", "place").agg(F.min("text").alias("text"))
    return [(r["kind"], r["text"]) for r in one.orderBy("kind", "place").collect()]
