"""Carrier response bodies on disk.

Every reader returns ``file``, ``block``, ``line``, ``pos`` and ``body`` as VARIANT. The first
four say which body came later (see ``BODY_ORDER``). They are told within one scan: another
scan may cut the files elsewhere, so nothing is joined by them.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwatch.functions.text import let, strip
from parcelwatch.sources import blocks

# Workers need not have this package: its scanner travels with the plan.
cloudpickle.register_pickle_by_value(blocks)

BODY_ORDER = ["file", "block", "line", "pos"]

# An indented array closes each member object on a line of its own.
_MEMBER_END = "\n  },\n"


def src_bodies(
    spark: SparkSession, path: str, layout: str = "document", *, on_corrupt: str = "fail"
) -> DataFrame:
    """Read bodies. ``layout`` says how a file holds them:

    ``document``  one JSON text per file, an array of bodies or a single body, formatted in any
                  way. Arrays are cut at their members, so a file of any size is split
                  across tasks, also where it is one line (see ``blocks``).
    ``lines``     one body per line; files are split across tasks.
    ``indented``  an array written with an indent of two, as this job's dumps are; it
                  is cut at member ends by built-in functions alone. Other arrays, and single
                  bodies, are read by one task a file; a single body in which a cut would fall is refused.

    Members are parsed one by one, so only a single body is bound by the size of a VARIANT.
    ``on_corrupt``: ``fail`` raises on a text that is not JSON or a body that is too large,
    ``skip`` drops it. With ``document`` a damaged member, a broken bracket or quote, or the end of a truncated file
    costs the members it touches and no others; ``quarantined_bodies`` says which.
    """
    if layout not in ("document", "lines", "indented"):
        raise ValueError(f"unknown layout: {layout}")
    if on_corrupt not in ("fail", "skip"):
        raise ValueError(f"unknown on_corrupt: {on_corrupt}")
    if layout == "document":
        return _document(spark, path, on_corrupt)
    try:
        raw = spark.read.text(path, lineSep=_MEMBER_END if layout == "indented" else None)
    except AnalysisException as ex:
        raise ValueError(f"no bodies at {path}") from ex
    raw = raw.select(
        _in_write_order(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    ).filter(strip(F.col("value")) != "")
    # A line is one body, also when that body is an array.
    texts = {"lines": _alone, "indented": lambda c: _members(_as_array(c))}[layout]
    parse = F.parse_json if on_corrupt == "fail" else F.try_parse_json
    members = raw.select("file", "block", "line", F.posexplode_outer(texts(F.col("value"))).alias("pos", "m"))
    text = F.col("m.text")
    # The text of a string member comes without its quotes.
    body = F.when(F.col("m.alone") | text.rlike(r"^\s*[\[{]"), parse(text)).otherwise(
        F.coalesce(F.try_parse_json(text), text.cast("variant"))
    )
    return members.select("file", "block", "line", "pos", body.alias("body")).filter(F.col("body").isNotNull())


def _document_members(spark: SparkSession, path: str) -> DataFrame:
    try:
        raw = spark.read.text(path, lineSep=blocks.RECORD_END.decode())
    except AnalysisException as ex:
        raise ValueError(f"no bodies at {path}") from ex
    records = raw.select(
        _in_write_order(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )
    found = blocks.members(records)
    text = F.col("text").cast("string")
    # An array without members, and a file without any text, have one blank text.
    empty = (strip(text) == "") & (~F.col("listed") | (F.coalesce("sound_end", F.lit(False)) & (F.col("block") == 0) & (F.col("line") == 0)))
    return found.where(~empty)


def _one_body(text: Column) -> Column:
    """Whether the text is one JSON value; the parser alone overlooks what follows the first."""
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.coalesce(F.size(listed) == 1, F.lit(False))


def _document(spark: SparkSession, path: str, on_corrupt: str) -> DataFrame:
    found = _document_members(spark, path)
    text, pos = F.col("text").cast("string"), F.lit(0).alias("pos")
    if on_corrupt == "fail":
        unfinished = F.raise_error(F.lit("an array does not end")).cast("variant")
        body = F.when(F.col("sound_end") == F.lit(False), unfinished).otherwise(F.parse_json(text))
        return found.select("file", "block", "line", pos, body.alias("body"))
    # One parse of each member; what cannot be parsed is searched for members.
    parsed = found.withColumn("body", F.when(_one_body(text), F.try_parse_json(text)))
    sound = parsed.where("body is not null").select("file", "block", "line", pos, "body")
    rest = blocks.salvage(parsed.where("body is null and listed").select("file", "block", "line", "offset", "text"))
    rest = rest.select("file", "block", "line", "pos", F.try_parse_json(text).alias("body")).where("body is not null")
    return sound.unionByName(rest)


def quarantined_bodies(spark: SparkSession, path: str) -> DataFrame:
    """What ``src_bodies(layout="document", on_corrupt="skip")`` leaves out: file, offset and length in bytes, cause, text.

    Offsets count from the end of a byte order mark.

    ``cause`` is ``not json`` (a member, or a stretch with broken brackets or quotes), ``too large`` (JSON beyond the size of a
    VARIANT), or ``truncated`` (the file's last member, in a file that does not end where it should; a sound last member
    is no loss and not listed).
    """
    found = _document_members(spark, path)
    text = F.col("text").cast("string")
    bad = found.where(~_one_body(text))
    whole = bad.where("not listed").select("file", "offset", "text", F.lit(False).alias("cut_off"))
    listed = bad.where("listed")
    pieces = blocks.salvage(listed.select("file", "block", "line", "offset", "text"))
    last = listed.where("sound_end = false").select("file", "block", "line", F.lit(True).alias("cut_off"))
    at_end = F.col("pos") == F.max("pos").over(Window.partitionBy("file", "block", "line"))
    pieces = pieces.withColumn("at_end", at_end).where(F.try_parse_json(text).isNull()).join(last, ["file", "block", "line"], "left")
    pieces = pieces.select("file", "offset", "text", (F.coalesce("cut_off", F.lit(False)) & F.col("at_end")).alias("cut_off"))
    large = F.length("text") > 16 << 20
    cause = F.when(F.col("cut_off"), "truncated").when(large & F.get_json_object(text, "$").isNotNull(), "too large").otherwise("not json")
    return whole.unionByName(pieces).select("file", "offset", F.length("text").cast("bigint").alias("length"), cause.alias("cause"), text.alias("text"))


def _in_write_order(path: Column) -> Column:
    """A path that compares as its writer numbered the files, also beyond 99,999 of them."""
    number = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1)
    padded = F.concat(F.lit("part-"), F.lpad(number, 12, "0"))
    return F.when(number == "", path).otherwise(F.regexp_replace(path, F.lit(r"part-\d+(?=[^/]*$)"), padded))


def _alone(text: Column) -> Column:
    return F.array(F.struct(text.alias("text"), F.lit(True).alias("alone")))


def _members(text: Column) -> Column:
    """The texts of an array's members, as they are written; any other text is one that stands alone."""

    def read(t: Column) -> Column:
        listed = F.from_json(F.ltrim(t, F.lit("\ufeff \t\r\n")), "array<string>")
        members = F.transform(listed, lambda m: F.struct(F.coalesce(m, F.lit("null")).alias("text"), F.lit(False).alias("alone")))
        return F.coalesce(F.when(t.rlike("^\ufeff?\\s*\\["), members), _alone(t))

    return let(text, read)


def _as_array(chunk: Column) -> Column:
    """One cut of an indented array as an array text of its own; a single body as it is.

    The first cut still has the opening bracket, the last one the closing bracket;
    all others lost the brace that ended their last member. Members are indented, so a
    brace at the start of a line is that of a single body, and what starts with a key is a
    piece of one.
    """

    def read(opened: Column) -> Column:
        closed = F.when(opened.rlike(r"(^|\n)\]\s*$"), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(
            F.concat(opened, F.lit("\n}"))
        )
        refused = F.raise_error(F.lit("a single body is cut; read it with the layout document")).cast("string")
        return (
            F.when(opened.rlike("^\ufeff?\\["), opened)
            .when(opened.rlike(r"^\{([^\n]*|(?s:.*)\n)\}\s*$"), opened)
            .when(opened.rlike(r'^(\{|\s*"([^"\\]|\\.)*"\s*:)'), refused)
            .otherwise(F.concat(F.lit("["), closed, F.lit("]")))
        )

    return let(F.regexp_replace(chunk, "^\ufeff?\\[\\s*\n", ""), read)


def sink_bodies(bodies: DataFrame, path: str, batch_id: int, order: str | None = None) -> None:
    """Append bodies, one JSON document per line, as batch ``batch_id``, in the order of column ``order``.

    Each batch is a directory of its own: earlier bodies are never rewritten, writing
    the same batch again replaces it, and later batches sort after earlier ones.
    """
    kind = bodies.schema["body"].dataType.simpleString()
    text = F.to_json("body") if kind == "variant" else F.col("body")
    if order is not None:
        bodies = bodies.repartitionByRange(order).sortWithinPartitions(order)
    bodies.select(text.alias("value")).write.mode("overwrite").text(
        f"{path.rstrip('/')}/batch={batch_id:012d}"
    )


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """All bodies appended so far; nothing there or unreadable lines give no rows."""
    try:
        return src_bodies(spark, f"{path.rstrip('/')}/batch=*", "lines", on_corrupt="skip")
    except ValueError:
        empty = "file string, block bigint, line bigint, pos int, body variant"
        return spark.createDataFrame([], empty)
