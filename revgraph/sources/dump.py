"""XML page dumps (S1, S2, P2), read revision by revision.

The text source splits a dump file at ``</revision>``, so a large file (plain
or bzip2) spreads over many tasks and a record is one revision, never a whole
page history. Each revision is parsed by Spark's ``from_xml`` with an explicit
schema: ``<text xml:space=...>`` loads as its text, an ``<ip>`` contributor as
a NULL username, leading white space of the text is kept (it decides whether a
token is a stop word).

A page's title stands before its first revision only. Within a block it is
carried forward in the order of the file. The same pass adds one row for each
block with the title open at its end; once the pass is stored, revisions at the
start of a block get the title open at the end of the blocks before from those
rows. So the text of a dump is read once.

What cannot be parsed is not lost: ``parse_revisions`` keeps it with a
``reject_reason``, ``read_revisions`` returns the good rows and
``rejected_revisions`` the others.

Limits: ``</revision>``, ``<revision`` and ``<page`` must not stand inside
CDATA sections or comments (dump texts escape ``<``), and a page's title must
precede its revisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revgraph.functions.text import revision_year
from revgraph.session import stored

ROW_TAG = "page"
ROOT_TAG = "mediawiki"
SEPARATOR = "</revision>"
XML = {"excludeAttribute": "true", "ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_corrupt_record"}

#: Place of a revision: its file, the block it was read in, and its number there.
PLACE = ["file", "block", "row"]
#: Carried instead of a title when a page's head cannot be read.
_UNREADABLE = "\x00"


def _chunks(df: DataFrame) -> DataFrame:
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def numbered(chunks: DataFrame) -> DataFrame:
    """Chunks of a batch with ``row``, which grows within each block."""
    return chunks.withColumn("row", F.monotonically_increasing_id())


def read_chunks(spark: SparkSession, paths) -> DataFrame:
    """Text up to each ``</revision>`` with its place."""
    return numbered(_chunks(spark.read.option("lineSep", SEPARATOR).text([paths] if isinstance(paths, str) else list(paths))))


def stream_chunks(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The chunks of new files, not numbered yet."""
    reader = spark.readStream.option("lineSep", SEPARATOR)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _chunks(reader.text(path))


def _head(value: Column) -> Column:
    """The title of the last page that begins in a chunk: NULL if none does, a mark if it cannot be read."""
    head = F.concat(F.lit("<page"), F.substring_index(F.substring_index(value, "<page", -1), "<revision", 1), F.lit("</page>"))
    parsed = F.from_xml(head, "title string, _corrupt_record string", XML)
    return F.when(value.contains("<page"), F.coalesce(F.when(parsed["_corrupt_record"].isNull(), parsed["title"]), F.lit(_UNREADABLE)))


def _carry_titles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fill the title forward within each block, keep revisions, and close each block with a row of its last title.

    Rows come in the order of the file.
    """
    now, known, schema = None, None, None

    def block_end() -> pa.RecordBatch:
        own = {"file": now[0], "block": now[1], "row": -1, "title": known, "text": "", "kind": BLOCK_END}
        return pa.RecordBatch.from_arrays([pa.array([own.get(f.name)], f.type) for f in schema], schema=schema)

    for batch in batches:
        schema = batch.schema
        file, block = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        cuts = [0, *(i for i in range(1, len(file)) if (file[i], block[i]) != (file[i - 1], block[i - 1])), len(file)] if file else []
        for a, b in zip(cuts, cuts[1:]):
            if now != (file[a], block[a]):
                if now is not None:
                    yield block_end()
                now, known = (file[a], block[a]), None
            part = batch.slice(a, b - a)
            title = pc.fill_null_forward(pa.concat_arrays([pa.array([known], pa.string()), part.column("title")]))
            known = title[-1].as_py()
            part = part.set_column(schema.get_field_index("title"), schema.field("title"), title.slice(1))
            yield part.filter(pc.equal(part.column("kind"), REVISION))
    if now is not None:
        yield block_end()


#: Kinds of rows of a parsed dump; chunks that hold no revision may still open a page.
REVISION, NO_REVISION, BLOCK_END = "revision", "no revision", "block end"


def parse_revisions(chunks: DataFrame) -> DataFrame:
    """``file, block, row, title, username, year, timestamp, text, record, reject_reason``.

    ``title`` is NULL for revisions of a page that began in an earlier block.
    A revision that cannot be parsed keeps its XML in ``record``, besides the
    fields that stand before the fault. Each block ends with a row whose
    ``reject_reason`` is ``BLOCK_END`` and whose title is the one open there.
    """
    value = F.col("value")
    record = F.concat(F.lit("<revision"), F.substring_index(value, "<revision", -1), F.lit(SEPARATOR))
    schema = "timestamp string, contributor struct<username:string>, text string, _corrupt_record string"
    held = value.contains("<revision")
    rows = chunks.select(
        *PLACE, _head(value).alias("title"), F.when(held, REVISION).otherwise(NO_REVISION).alias("kind"), F.when(held, F.from_xml(record, schema, XML)).alias("r")
    )
    flat = rows.select(
        *PLACE, "title",
        F.col("r.contributor.username").alias("username"),
        revision_year(F.col("r.timestamp")).alias("year"),
        F.col("r.timestamp").alias("timestamp"),
        F.coalesce("r.text", F.lit("")).alias("text"),
        F.col("r._corrupt_record").alias("record"),
        "kind",
    )
    carried = flat.mapInArrow(_carry_titles, flat.schema)
    reason = F.when(F.col("kind") == BLOCK_END, BLOCK_END).when(F.col("record").isNotNull(), "malformed revision")
    reason = reason.when(F.col("title") == _UNREADABLE, "page without a readable title").when(F.col("year").isNull(), "revision without a timestamp")
    return carried.withColumn("reject_reason", reason).drop("kind")


def split_ends(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The revisions of a parsed (and stored) dump, and ``file, block, open_title``: the page open at the start of each block."""
    ended = F.col("reject_reason") == BLOCK_END
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = parsed.where(ended).select("file", "block", F.last("title", ignorenulls=True).over(before).alias("open_title"))
    return parsed.where(F.coalesce(~ended, F.lit(True))), ends


def with_titles(revisions: DataFrame, heads: DataFrame) -> DataFrame:
    """Give revisions without a title that of the page open before their block."""
    out = revisions.join(heads, ["file", "block"], "left")
    title = F.coalesce("title", "open_title", F.lit(_UNREADABLE))
    reason = F.coalesce("reject_reason", F.when(title == _UNREADABLE, "page without a readable title"))
    return out.select(*PLACE, F.when(title != _UNREADABLE, title).alias("title"), *[c for c in revisions.columns if c not in (*PLACE, "title", "reject_reason")], reason.alias("reject_reason"))


def read_revisions(spark: SparkSession, paths) -> DataFrame:
    """One row per revision: ``title, username, year, timestamp, text, pos``; ``pos`` orders a page's revisions.

    The parsed revisions are stored once, so the dump is read once.
    """
    parsed = stored(parse_revisions(read_chunks(spark, paths)), "revisions")
    good = with_titles(*split_ends(parsed)).where("reject_reason IS NULL")
    return good.select("title", "username", "year", "timestamp", "text", F.struct("block", "row").alias("pos"))


REJECT = ["file", "block", "title", "timestamp", "record", "reject_reason"]


def rejected_revisions(spark: SparkSession, paths) -> DataFrame:
    """What ``read_revisions`` leaves out, with the reason and, if it could not be parsed, the XML.

    Stored in between are only rejected revisions and those that wait for a title, without their text.
    """
    parsed = parse_revisions(read_chunks(spark, paths)).where(F.col("reject_reason").isNotNull() | F.col("title").isNull())
    waiting = stored(parsed.drop("text"), "rejects")
    return with_titles(*split_ends(waiting)).where("reject_reason IS NOT NULL").select(*REJECT)


def write_dump(pages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write dump-shaped rows (``title``, ``revision``) as MediaWiki-like XML."""
    (
        pages.write.format("xml")
        .option("rootTag", ROOT_TAG)
        .option("rowTag", ROW_TAG)
        .mode(mode)
        .save(path)
    )
