"""Line dedup by content-defined chunks, in DataFrame functions.

A text is a sequence of units: its lines (with blank lines that follow), and
within lines of several sentences the sentences (those of fewer than
``SENTENCE`` characters are one with what follows). A chunk starts at every unit
and ends where its own content says: with the first unit that brings it to
``MIN_UNITS`` units and ``MIN_BYTES`` bytes, some ten words (a unit of
``LONG_BYTES``, some fifty words, is a chunk by itself; where ``MAX_UNITS`` units
have fewer bytes, no chunk starts). Its hash is rolled over the hashes of its units. So the chunks
of a passage depend on the passage only, wherever it stands, and text inserted
before or after it moves none of its borders. Chunks that overlap cover a
repeated passage of many lines as a whole.

A chunk that occurs more than once in the corpus keeps its first occurrence (by
document id, then place); the units of all others are removed from their texts.
Equal hashes only make candidates: the bytes of the chunks of equal hash and
digest are compared, and where they differ they are told apart by their texts. Every unit removed is left at another place:
the first occurrence of a chunk comes before the one removed, and so on down to
a place that no chunk removes.

Hashes alone are counted first, so of most chunks only eight bytes are
shuffled, after a partial aggregation. Two shuffles carry texts: one brings the
places of the candidates to the documents, one the places to remove. The rows of
a chunk that many documents have are dealt over ``SALTS`` parts in a join and
combined by task before an aggregation.

A null text has no chunks and stays null; an empty text and one without a word
stay as they are. Very long texts are cut as a whole, in the memory of one row.
Null ids come last. Rows of equal id and text count as one document and get the
same result. An empty table gives an empty result. All other columns are
carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxiframe.llm.common import SALTS, column, fresh, let, materialize, row_key

#: Characters of a sentence that is a unit of its own.
SENTENCE = 32
#: A sentence with its blanks, a line with its end and blank lines, or the rest
#: of the text.
UNIT = r"[^\n]{%d,}?[.!?] +|[^\n]*\n[ \t\r\n]*|[^\n]+" % SENTENCE
BLANK = " \t\r\n"
#: A chunk has at least so many units and bytes, and at most so many units.
MIN_UNITS, MIN_BYTES, MAX_UNITS = 2, 50, 8
#: A unit of so many bytes spans several lines of a page.
LONG_BYTES = 300
#: A hash with a larger share of all chunks than one in so many is hot.
HOT = 1000


def units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def content(unit: Column) -> Column:
    """A unit without the blanks and line ends at its end."""
    return F.rtrim(unit, F.lit(BLANK))


def chunk_units(measured: Column, i: Column) -> Column:
    """Units of the chunk that starts at unit ``i``; null where none does.
    ``measured``: structs with the ``bytes`` of each unit."""
    size = lambda j: F.get(measured, j)["bytes"]
    n, total = F.when(size(i) >= LONG_BYTES, F.lit(1)), size(i)
    for units_ in range(2, MAX_UNITS + 1):
        total = total + size(i + (units_ - 1))
        if units_ >= MIN_UNITS:
            n = n.when(total >= MIN_BYTES, F.lit(units_))
    return n


def chunks(text: Column) -> Column:
    """``array<struct<first,n,hash>>`` of the chunks of a text: the place of the
    first unit, the number of units, and the hash."""
    def measure(unit: Column) -> Column:
        return F.struct(F.xxhash64(unit).alias("hash"), F.octet_length(unit).alias("bytes"))

    def cut(m: Column) -> Column:
        def chunk(x: Column, i: Column) -> Column:
            # Rolled over the chunk's units; the usual two are hashed at once.
            two = F.xxhash64(x["hash"], F.get(m, i + 1)["hash"])
            rolled = lambda n: F.when(n == 2, two).otherwise(F.xxhash64(F.transform(
                F.slice(m, i + 1, n), lambda u: u["hash"])))
            return let(chunk_units(m, i), lambda n: F.when(n.isNotNull(), F.struct(
                i.alias("first"), n.alias("n"), rolled(n).alias("hash"))))

        return F.filter(F.transform(m, chunk), lambda c: c.isNotNull())

    return let(F.transform(units(text), lambda u: measure(content(u))), cut)


def spread(rows: DataFrame, table: DataFrame, on: Column, row_hash: str, table_hash: str, hot: list[int], how: str) -> DataFrame:
    """Join of rows with a table of unique keys; the rows of hot hashes are dealt
    over ``SALTS`` parts, and only the table rows of these hashes are copied."""
    part = F.when(F.col(row_hash).isin(hot), F.pmod(F.hash("key"), F.lit(SALTS))).otherwise(F.lit(0))
    parts = F.when(F.col(table_hash).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = table.withColumn("table_part", F.explode(parts))
    return rows.withColumn("row_part", part).join(dealt, on & (F.col("row_part") == F.col("table_part")), how)


def repeated_places(cut: DataFrame) -> tuple[DataFrame, list[int]]:
    """``in_key`` and ``places``: the chunks of a row whose hash occurs twice; and
    the hot hashes. ``cut``: rows of ``key, chunks``."""
    hashes = cut.select(F.explode(F.transform("chunks", lambda c: c["hash"])).alias("hash"))
    again = materialize(hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("hash").alias("repeated"), "n"), "line-repeated")
    # Fewer than HOT hashes, however many chunks there are.
    total = cut.agg(F.sum(F.size("chunks").cast("long"))).first()[0] or 0
    hot = [r["repeated"] for r in again.where(F.col("n") * HOT > total).collect()]
    rows = cut.select("key", F.explode("chunks").alias("c")).select("key", "c.hash", "c.first", "c.n")
    likely = spread(rows, again.select("repeated"), F.col("hash") == F.col("repeated"), "hash", "repeated", hot, "left_semi")
    return likely.groupBy(F.col("key").alias("in_key")).agg(
        F.collect_set(F.struct("first", "n", "hash")).alias("places")), hot


def first_places(shown: DataFrame) -> DataFrame:
    """For each group ``of`` of chunks: the first and the last of its places, the
    least and the greatest of its texts. ``shown``: ``ident, key, first, of, chunk``."""
    place = F.struct("ident", "key", "first")
    return shown.groupBy("of").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.min("chunk").alias("a"),
                                   F.max("chunk").alias("b")).where("low != high")


def removed_units(docs: DataFrame, doc_id: str, text: str, digest=None) -> DataFrame:
    """``key`` of a row, ``chunks`` (how many are removed) and ``gone``, the
    places of the units to remove from it. ``digest``: a second hash of chunks."""
    given = column(doc_id)
    texts = docs.select(row_key(given, column(text)).alias("key"),
                        F.struct(given.isNull().alias("no_id"), given.alias("id")).alias("ident"), column(text).alias("text"))
    cut = materialize(texts.select("key", chunks(F.col("text")).alias("chunks")).where(F.size("chunks") > 0), "line-chunks")
    # The chunks themselves, for documents that have candidates.
    places, hot = repeated_places(cut)
    held = texts.join(places, F.col("key") == F.col("in_key"))
    shown = held.select("key", "ident", F.transform(units(F.col("text")), content).alias("u"), "places").select(
        "key", "ident", F.explode(F.transform("places", lambda p: F.struct(
            p["first"].alias("first"), p["n"].alias("n"), p["hash"].alias("hash"), F.array_join(
                F.slice("u", p["first"] + 1, p["n"]), "\n").alias("chunk")))).alias("c")).select("key", "ident", "c.*")
    second = F.xxhash64(F.lit("chunk"), "chunk") if digest is None else digest(F.col("chunk"))
    group = lambda text: F.struct("hash", "digest", text.alias("text"))
    shown = materialize(shown.withColumn("digest", second), "line-candidates").withColumn("of", group(F.lit(None).cast("string")))
    # Byte comparison: the least and the greatest text of a group are the same.
    found = materialize(first_places(shown).select(
        F.col("of").alias("in_group"), "low.key", "low.first", (F.col("a") == F.col("b")).alias("same")), "line-groups")
    rows = shown.select("key", "first", "n", "of")
    if not found.where("NOT same").isEmpty():  # different texts of equal hashes: the text itself makes the group
        mixed = found.where("NOT same").select("in_group")
        inside = F.col("of").eqNullSafe(F.col("in_group"))
        apart = shown.join(mixed, inside, "left_semi").withColumn("of", group(F.col("chunk")))
        rows = rows.join(mixed, inside, "left_anti").unionByName(apart.select("key", "first", "n", "of"))
        found = found.where("same").drop("same").unionByName(
            first_places(apart).select(F.col("of").alias("in_group"), "low.key", "low.first"))
    kept = found.select("in_group", F.col("key").alias("kept_key"), F.col("first").alias("kept_first"))
    same = spread(rows, kept, F.col("of").eqNullSafe(F.col("in_group")), "of.hash", "in_group.hash", hot, "inner")
    later = same.where((F.col("key") != F.col("kept_key")) | (F.col("first") != F.col("kept_first")))
    # Rows of equal id and text give the same places.
    spans = later.groupBy("key").agg(F.collect_set(F.struct("first", "n")).alias("spans"))
    return spans.select("key", F.size("spans").alias("chunks"), F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1)))).alias("gone"))


def without(text: Column, gone: Column) -> Column:
    """The text without the units at the places ``gone``."""
    # The difference of arrays takes a step for each unit, also of a long text.
    def left(u: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(u) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.get(u, i)), "")

    return let(units(text), left)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the units of repeated chunks removed from ``text``, and a
    struct ``removed`` of the numbers of chunks and units removed (where that
    name is taken, one with underscores before it)."""
    name, key = fresh("removed", docs.columns), fresh("row_key", docs.columns)
    gone = removed_units(docs, doc_id, text).withColumnsRenamed({"key": "_" + key, "gone": "_" + name, "chunks": "__" + name})
    keyed = docs.withColumn(key, row_key(column(doc_id), column(text)))
    joined = keyed.join(gone, F.col(key) == F.col("_" + key), "left")
    places = F.col("_" + name)
    cleaned = F.when(places.isNull(), column(text)).otherwise(without(column(text), places))
    counted = F.struct(F.coalesce(F.col("__" + name), F.lit(0)).cast("long").alias("chunks"),
                       F.coalesce(F.size(places), F.lit(0)).cast("long").alias("units"))
    return joined.select(*[cleaned.alias(c) if c == text else column(c) for c in docs.columns], counted.alias(name))
