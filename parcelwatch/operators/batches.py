"""Batched carrier requests and their responses, as tables."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwatch.functions import payload as P
from parcelwatch.functions.text import key_text, strip_sql
from parcelwatch.operators.lookup import _left_by_key, carrier_map, pointers_and_bodies, replay_lookup
from parcelwatch.schema import CARRIER_CODE, TRACKING_NUMBER, col, has
from parcelwatch.sources.scratch import stored

# Numbers per request, and envelope keys in unwrap order.
BATCH_SIZE = 30
ENVELOPES = ("output", "body", "response", "data")

#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
_PLACE_BITS = 33


def global_rank(df: DataFrame, order: str) -> DataFrame:
    """Add ``rank``: the zero-based position of each row by a unique bigint column; NULL in it is refused.

    A running count over the whole table would need one task. Instead the rows are dealt by range, sorted within
    their partitions and written with partition and place. The rank of a row is its place plus the exact number of rows in
    the partitions before its own, so it is right whatever splitters the ranges have; they only decide how even the
    partitions are. What reaches the driver is one count per partition. The table is written when this is called.
    """
    o = F.coalesce(col(order).cast("bigint"), F.raise_error(F.lit(f"{order} must not be NULL")).cast("bigint"))
    dealt = df.withColumn("_o", o).repartitionByRange("_o").sortWithinPartitions("_o").drop("_o")
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part, place = F.shiftright("_at", _PLACE_BITS), F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("_part")).agg(F.max(place) + 1).collect())
    before = accumulate((n for _, n in sizes), initial=0)
    starts = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)], "_part bigint, _before bigint")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn("rank", F.col("_before") + place)
        .drop("_part", "_before", "_at")
    )


def number_batches(rows: DataFrame, order: str, size: int = BATCH_SIZE) -> DataFrame:
    """Non-blank tracking numbers in row order, duplicates kept, cut into batches of ``size``.

    Columns: ``batch``, ``slot``, ``tracking_number``, ``carrier_code`` (the last
    non-blank carrier of the number in the whole table, else NULL).
    """
    # Dealing by range reads its input twice and the carriers once more: only these columns, from one computation.
    rows = stored(rows.select(*(col(c) for c in dict.fromkeys((order, TRACKING_NUMBER, CARRIER_CODE)) if has(rows, c))), "numbers")
    listed = rows.select(
        col(order).alias("_order"), key_text(col(TRACKING_NUMBER)).alias("tracking_number")
    ).filter(F.col("tracking_number").isNotNull())
    carriers = carrier_map(rows, order).filter(F.col("carrier_code").isNotNull())
    ranked = global_rank(listed, "_order").join(carriers, "tracking_number", "left")
    return ranked.select(
        F.floor(F.col("rank") / size).alias("batch"),
        (F.col("rank") % size).cast("int").alias("slot"),
        "tracking_number",
        "carrier_code",
    )


def request_batches(rows: DataFrame, order: str, size: int = BATCH_SIZE) -> DataFrame:
    """One request document per batch: (``batch``, ``request`` JSON text)."""
    entry = F.struct(
        F.struct("tracking_number").alias("info"), F.col("carrier_code").alias("carrier")
    )
    batches = number_batches(rows, order, size).groupBy("batch").agg(
        F.sort_array(F.collect_list(F.struct("slot", entry.alias("e")))).alias("entries")
    )
    tracking = F.transform(
        "entries",
        lambda x: F.struct(
            F.struct(x["e"]["info"]["tracking_number"].alias("trackingNumber")).alias(
                "trackingNumberInfo"
            ),
            x["e"]["carrier"].alias("carrierCode"),
        ),
    )
    request = F.struct(tracking.alias("trackingInfo"), F.lit(True).alias("includeDetailedScans"))
    return batches.select(
        "batch", F.to_json(request, {"ignoreNullFields": "true"}).alias("request")
    )


# ---- responses -----------------------------------------------------------------


_RESULTS = "$.completeTrackResults"


def response_results(body: str = "body") -> str:
    """SQL text: results of a response, its own list or the list inside all nested envelopes."""
    inner = body
    for i, key in enumerate(ENVELOPES):
        step = P.variant_at(f"env{i}", f"$.{key}")
        inner = P.bind(f"env{i}", inner, f"CASE WHEN {P.is_object(step)} THEN {step} ELSE env{i} END")
    own = P.variant_at(body, _RESULTS, "array<variant>")
    return f"coalesce({own}, {P.variant_at(inner, _RESULTS, 'array<variant>')})"


def unwrap_envelope(body: str = "body") -> str:
    """SQL text: content of the first envelope key that holds an object, else the body."""
    steps = [P.variant_at(body, f"$.{k}") for k in ENVELOPES]
    whens = " ".join(f"WHEN {P.is_object(s)} THEN {s}" for s in steps)
    return f"CASE {whens} ELSE {body} END"


def _response_numbers(result: str = "result") -> str:
    """SQL text: a result's own number, else all its nested numbers, stripped."""
    own = f"nullif({strip_sql('typ.trackingNumber')}, '')"
    nested = (
        f"transform({P.present('typ.trackResults')}, "
        f"trk -> nullif({strip_sql('trk.trackingNumberInfo.trackingNumber')}, ''))"
    )
    return P.bind(
        "typ",
        P.variant_at(result, "$", P.RESULT_SHAPE),
        f"CASE WHEN {own} IS NOT NULL THEN array({own}) ELSE array_distinct({P.present(nested)}) END",
    )


def split_batch_response(responses: DataFrame) -> DataFrame:
    """(``batch``, ``body``) -> one payload per number: (``batch``, ``tracking_number``, ``payload``).

    The last result of a number wins. A result travels once, to the partition where
    the requested numbers join it on the same two keys.
    """
    results = responses.select(
        "batch", F.posexplode_outer(F.expr(response_results())).alias("at", "result")
    )
    numbered = results.select(
        "batch",
        "at",
        "result",
        F.explode_outer(F.expr(_response_numbers())).alias("tracking_number"),
    )
    return (
        numbered.filter(F.col("tracking_number").isNotNull())
        .groupBy("batch", "tracking_number")
        .agg(F.max_by("result", "at").alias("result"))
        .select(
            "batch",
            "tracking_number",
            F.to_variant_object(F.struct(F.array("result").alias("completeTrackResults"))).alias("payload"),
        )
    )


def batch_result_or_body(requested: DataFrame, responses: DataFrame) -> DataFrame:
    """Payload of each requested (``batch``, ``tracking_number``).

    Its own result, else the whole response of its batch, whatever that is (one that is
    no object cannot be read, so its rows keep what they have), else an empty object: a
    batch without a response row (no access token, failed call) gives empty objects.
    """
    known = (
        requested.select("batch", "tracking_number")
        .distinct()
        .join(split_batch_response(responses), ["batch", "tracking_number"], "left")
    )
    # A whole response meets only the numbers that have no result of their own.
    keyed = known.withColumn("_key", F.when(F.col("payload").isNull(), F.col("batch").cast("string")))
    whole = responses.select(F.col("batch").cast("string").alias("_tn"), "body")
    return _left_by_key(keyed, whole).select(
        "batch", "tracking_number", F.coalesce("payload", "body", F.parse_json(F.lit("{}"))).alias("payload")
    )


def last_batch_payload(payloads: DataFrame) -> DataFrame:
    """A number requested in several batches keeps the payload of the last one."""
    return payloads.groupBy("tracking_number").agg(F.max_by("payload", "batch").alias("payload"))


def batch_then_single(
    rows: DataFrame, payloads: DataFrame, bodies: DataFrame, order: list[str]
) -> DataFrame:
    """Per distinct number: its batch payload when there is one, else the replayed body.

    A batch payload counts even when it is empty. Returns (``tracking_number``, ``body``).
    """
    numbers = (
        rows.select(key_text(col(TRACKING_NUMBER)).alias("tracking_number"))
        .filter(F.col("tracking_number").isNotNull())
        .distinct()
    )
    known = numbers.join(last_batch_payload(payloads), "tracking_number", "left")
    # Numbers with a payload look nothing up.
    open_number = F.when(F.col("payload").isNull(), F.col("tracking_number"))
    return replay_lookup(known, bodies, order, key=open_number).select(
        "tracking_number", F.coalesce("payload", "body").alias("body")
    )


def map_number_to_body(bodies: DataFrame, order: list[str]) -> DataFrame:
    """Own number of each result -> unwrapped body that holds it, the last body winning.

    Like the replay index this moves numbers only; the bodies are fetched at the end.
    """
    results = P.variant_at("body", _RESULTS, "array<variant>")
    number = strip_sql(P.variant_at("res", "$.trackingNumber", "string"))
    own = F.expr(f"array_distinct(filter(transform({results}, res -> {number}), key -> key <> ''))")

    def numbers(marked: DataFrame, keys: list[str]) -> DataFrame:
        return marked.select(*keys, F.explode_outer(own).alias("tracking_number")).filter(F.col("tracking_number").isNotNull())

    unwrapped = bodies.withColumn("body", F.expr(unwrap_envelope()))
    last, found = pointers_and_bodies(unwrapped, order, numbers)
    return last.join(found, "digest").select("tracking_number", *order, "body")


__all__ = [
    "BATCH_SIZE",
    "batch_result_or_body",
    "batch_then_single",
    "global_rank",
    "last_batch_payload",
    "map_number_to_body",
    "number_batches",
    "request_batches",
    "response_results",
    "split_batch_response",
    "unwrap_envelope",
]
