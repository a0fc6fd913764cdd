"""Operator 6 [native]: document fingerprints as threshold-scaled sketches.

A sketch retains every shingle hash below a fixed fraction of the hash range, so its size follows the
document, sketches of parts merge by union, and the share of one sketch found in another estimates
containment however unequal the documents are. Texts of at most ``SHORT`` distinct shingles retain all of
them; a comparison uses the hashes below the threshold that both sides retained.

Everything is DataFrame functions: the sketches are array expressions over words, and the next
document comes from a window over id ranges. Each range gets one more row, the first one of the
range after it, so ranges are independent and no window spans the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SHINGLE = 5
FRACTION = 8
SHORT = 256
_LIMIT = -(1 << 63) + (1 << 64) // FRACTION


def with_sketch(frame: DataFrame, text: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """Adds struct ``name`` (hashes array<long> sorted, whole boolean) for the column ``text``.

    A null or empty text has no hashes. A text with fewer words than a shingle has its whole word
    sequence as its only one.
    """
    frame = frame.withColumn("_words", F.transform(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w)))
    many = F.size("_words") >= shingle
    rolled = F.slice(F.transform("_words", lambda w, i: F.xxhash64(w, *(F.get(F.col("_words"), i + k) for k in range(1, shingle)))), 1, F.greatest(F.size("_words") - (shingle - 1), F.lit(1)))
    single = F.when(F.size("_words") > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<long>"))
    frame = frame.withColumn("_all", F.array_distinct(F.when(many, rolled).otherwise(single))).withColumn("_whole", F.size("_all") <= SHORT)
    kept = F.when(F.col("_whole"), F.col("_all")).otherwise(F.filter("_all", lambda h: h < F.lit(_LIMIT)))
    return frame.withColumn(name, F.struct(F.sort_array(kept).alias("hashes"), F.col("_whole").alias("whole"))).drop("_words", "_all", "_whole")


def containment(a: str, b: str) -> Column:
    """The share of the smaller sketch that the larger holds, 0 to 1. Two empty sketches are alike
    (1); an empty and another one are not (0); null if a sketch is missing."""
    x, y = F.col(f"{a}.hashes"), F.col(f"{b}.hashes")
    low = [F.when(F.col(f"{other}.whole"), h).otherwise(F.filter(h, lambda v: v < F.lit(_LIMIT))) for h, other in ((x, b), (y, a))]
    least = F.least(F.size(low[0]), F.size(low[1]))
    return F.when(x == y, F.lit(1.0)).when(least > 0, F.size(F.array_intersect(*low)) / least).when(x.isNotNull() & y.isNotNull(), F.lit(0.0))


def as_text(sketch: str) -> Column:
    """A sketch as a string of hexadecimal hashes; ``*`` marks one that holds all of its text."""
    return F.concat(F.when(F.col(f"{sketch}.whole"), "*").otherwise(""), F.array_join(F.transform(F.col(f"{sketch}.hashes"), lambda h: F.lower(F.hex(h))), " "))


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts are at most ``doc_id``: coarse steps first, then those inside one step."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    longs = lambda values: F.array(*(F.lit(v) for v in values)).cast("array<long>")
    coarse = F.size(F.filter(longs(cuts[::step]), lambda v: v <= doc_id))
    fine = F.size(F.filter(F.slice(longs(cuts), (coarse - 1) * step + 1, F.lit(step)), lambda v: v <= doc_id))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + fine)


def with_next(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """``documents (id, text)`` with ``sketch``, and ``next`` (text, sketch) of the next document by
    descending id, after the last one the first. Rows that share an id follow each other by text.
    Rows without an id have no next one."""
    spark = documents.sparkSession
    ranges = ranges or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = documents.select("id").where("id is not null")
    shares = [k / ranges for k in range(1, ranges)]
    cuts = sorted({int(v) for v in ids.approxQuantile("id", shares, 0.25 / ranges)}) if shares else []
    placed = documents.withColumn("range", F.when(F.col("id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(ranges)).cast("int")).otherwise(_range_of(F.col("id"), cuts)))
    heads = sorted(placed.where("id is not null").groupBy("range").agg(F.max("id")).collect(), reverse=True)
    # One row for each range: the first document of a range also stands at the end of the one before.
    last_rows = [(heads[k][1], heads[k - 1][0]) for k in range(len(heads))]
    guests = documents.join(F.broadcast(spark.createDataFrame(last_rows, "id long, range int")), "id").select("id", "text", "range") if heads else placed.limit(0)
    rows = with_sketch(placed.withColumn("guest", F.lit(False)), "text", "sketch").unionByName(with_sketch(guests.withColumn("guest", F.lit(True)), "text", "sketch"))
    order = Window.partitionBy("range").orderBy("guest", F.desc("id"), "text")
    following = F.lead(F.struct("text", "sketch")).over(order)
    return rows.withColumn("next", F.when(F.col("id").isNotNull(), following)).where("not guest").drop("range", "guest")


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of whole texts, of edited texts, and how alike they are.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or
    all) of the next document by descending doc_id. Returns one row for each input row: doc_id,
    n_chars (long), edited_sha256, fingerprint, edited_fingerprint (string), near_edited, near_next
    (double, 0 to 1).

    A null text is empty: its fingerprint is ``*``. Rows that share an id follow each other in the
    order of their texts. Rows without an id have no next document: nothing replaces what is cut
    and near_next is 0. An empty table gives an empty result; other columns are not read.
    """
    rows = with_next(documents.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.coalesce(F.substring(F.col("next.text"), F.lit(1), cut), F.lit(""))))
    rows = with_sketch(rows.withColumn("after", F.col("next.sketch")), "edited", "edited_sketch")
    return rows.select(
        F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"), as_text("edited_sketch").alias("edited_fingerprint"),
        containment("sketch", "edited_sketch").alias("near_edited"), F.coalesce(containment("sketch", "after"), F.lit(0.0)).alias("near_next"),
    )
