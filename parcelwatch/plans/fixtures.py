"""Shipments and carrier bodies derived from the star-schema tables.

The SQL texts run unchanged in Spark and in DuckDB, so a result over the JSON bodies can
be checked against one computed straight from the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Events are captured in runs of this many ids, so a body never holds more than that.
CAPTURE_IDS = 5000
GROUP_USERS = 30

# Half of the numbers have no events, numbers repeat, some are padded, some blank.
SHIPMENTS_SQL = """
SELECT 'drop-me' AS lead, o_orderkey AS row_id,
 CASE WHEN o_orderkey % 97 = 0 THEN ' nan '
      WHEN o_orderkey % 89 = 0 THEN NULL
      WHEN o_orderkey % 11 = 0 THEN '  ' || CAST(o_custkey % (SELECT 2 * MAX(user_id) + 2 FROM {events}) AS STRING) || ' '
      ELSE CAST(o_custkey % (SELECT 2 * MAX(user_id) + 2 FROM {events}) AS STRING) END AS tracking_number,
 CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 'none'
      WHEN o_orderkey % 3 = 0 THEN 'FEDEX' WHEN o_orderkey % 3 = 1 THEN ' FDX ' ELSE 'ups' END AS carrier_code,
 CASE WHEN o_orderkey % 50 = 0 THEN 'N/A'
      WHEN o_orderkey % 7 = 0 THEN CAST(MONTH(o_orderdate) AS STRING) || '/' || CAST(DAY(o_orderdate) AS STRING)
                                   || '/' || CAST(YEAR(o_orderdate) AS STRING)
      ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS promised_delivery_date,
 CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'In transit' END AS delivery_tracking_status
FROM {orders}
"""

EVENTS_SQL = f"""
SELECT event_id, user_id, CAST(user_id AS STRING) AS tracking_number, ts,
 CASE event_type WHEN 'signup' THEN 'OC' WHEN 'purchase' THEN 'DL' WHEN 'error' THEN 'DE'
                 WHEN 'view' THEN 'SE' ELSE 'IT' END AS code,
 CASE event_type WHEN 'signup' THEN 'Label created' WHEN 'purchase' THEN 'Delivered'
                 WHEN 'error' THEN 'Delivery exception' WHEN 'view' THEN 'Shipment exception'
                 ELSE 'In transit' END AS status,
 CASE WHEN event_type = 'click' AND event_id % 7 < 3 THEN 'Returning package to shipper'
      WHEN event_type = 'view' THEN 'Unable to deliver' ELSE event_type END AS description,
 CASE event_type WHEN 'error' THEN 'Damaged - handling 039' WHEN 'view' THEN 'Unable to  deliver Call us'
                 ELSE '' END AS ancillary,
 CASE WHEN event_id % 2 = 0 THEN REPLACE(CAST(ts AS STRING), ' ', 'T') || 'Z'
      ELSE REPLACE(CAST(ts - INTERVAL '4' HOUR AS STRING), ' ', 'T') || '-04:00' END AS date_text,
 CAST(FLOOR(event_id / {CAPTURE_IDS}) AS BIGINT) AS capture
FROM {{events}}
"""

# One row per event with everything the flag rules read, including seeds and bad values.
RULES_SQL = f"""
SELECT event_id, code, status, description, ancillary,
 CASE WHEN event_id % 23 = 0 THEN '' ELSE code END AS derived,
 CASE WHEN event_id % 29 = 0 THEN 'bad' WHEN event_id % 31 = 0 THEN CAST(event_id % 8 AS STRING) || '.7'
      ELSE CAST(event_id % 8 AS STRING) END AS days,
 event_id % 5 AS scans,
 CASE WHEN event_id % 17 = 0 THEN '1' WHEN event_id % 17 = 1 THEN 'x' ELSE '0' END AS seed_delivered,
 CASE WHEN event_id % 19 = 0 THEN 1 ELSE 0 END AS seed_rts
FROM ({EVENTS_SQL}) AS e
"""

BODY_ORDER = ["capture", "kind", "part"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in ("orders", "events") if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, EVENTS_SQL)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input table as a user has it: a lead column to drop, named columns, all text."""
    return run(spark, sf_dir, SHIPMENTS_SQL).select(
        F.col("lead").alias("X"),
        F.col("row_id").alias("RowId"),
        F.col("tracking_number").alias("Tracking Number"),
        F.col("carrier_code").alias("Carrier Code"),
        F.col("promised_delivery_date").alias("Promised Delivery Date"),
        F.col("delivery_tracking_status").alias("Delivery Tracking Status"),
    )


def rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RULES_SQL).select(
        "event_id",
        "code",
        F.col("derived").alias("derivedCode"),
        F.col("status").alias("statusByLocale"),
        "description",
        F.col("ancillary").alias("LatestAncillaryText"),
        F.col("days").alias("DaysSinceLatestEvent"),
        F.col("scans").alias("ScanEventsCount"),
        F.col("seed_delivered").alias("IsDelivered"),
        F.col("seed_rts").alias("IsRTS"),
    )


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capture and user: the ``result`` struct of a deep body and the flat fields.

    Users fall in five kinds by ``user_id % 5``: 0 to 2 have a status detail (1 without
    derived code but with an announced date, 2 matched by the nested number only), 3 has
    scan events only, 4 is a flat body.
    """
    ev = events(spark, sf_dir).withColumn("part", F.floor(F.col("user_id") / GROUP_USERS))
    # One shuffle serves both groupings. A group holds at most CAPTURE_IDS events. Its rows are few bytes for the work
    # that follows, so partitions are numbered: merged by size, they leave one long task after the others.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_user = (
        ev.repartition(parts, "capture", "part")
        .groupBy("capture", "part", "user_id", "tracking_number")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("ts", "event_id", "code", "status", "description", "date_text")
                ),
                asc=False,
            ).alias("h")
        )
        .withColumn("last", F.col("h")[0])
        .withColumn("kind", F.col("user_id") % 5)
    )
    kind, last = F.col("kind"), F.col("last")
    number = F.col("tracking_number")
    ancillary = F.when(
        last["code"] == "DE",
        F.array(
            F.struct(
                F.lit("039").alias("reason"),
                F.lit("Damaged - handling").alias("reasonDescription"),
                F.lit(None).cast("string").alias("action"),
                F.lit(None).cast("string").alias("actionDescription"),
            )
        ),
    ).when(
        last["code"] == "SE",
        F.array(
            F.struct(
                F.lit(None).cast("string").alias("reason"),
                F.lit(None).cast("string").alias("reasonDescription"),
                F.lit("Call us").alias("action"),
                F.lit("Unable to  deliver").alias("actionDescription"),
            )
        ),
    )
    detail = F.when(
        kind <= 2,
        F.struct(
            F.when(kind == 2, F.concat(F.lit("X"), last["code"]))
            .otherwise(last["code"])
            .alias("code"),
            F.when(kind != 1, last["code"]).alias("derivedCode"),
            last["status"].alias("statusByLocale"),
            last["description"].alias("description"),
            ancillary.alias("ancillaryDetails"),
        ),
    )

    def scan(e):
        even = e["event_id"] % 2 == 0
        return F.struct(
            e["date_text"].alias("date"),
            e["code"].alias("eventType"),
            e["description"].alias("eventDescription"),
            F.when(even, e["code"]).alias("derivedStatusCode"),
            F.when(even, e["status"]).alias("derivedStatus"),
        )

    announced = F.concat(
        F.replace((last["ts"] + F.expr("INTERVAL '12' HOUR")).cast("string"), F.lit(" "), F.lit("T")),
        F.lit("Z"),
    )
    result = F.struct(
        F.when(kind != 2, number).alias("trackingNumber"),
        F.array(
            F.struct(
                F.when(
                    (kind == 2) | (F.col("user_id") % 2 == 0),
                    F.struct(number.alias("trackingNumber"), F.lit("FDXG").alias("carrierCode")),
                ).alias("trackingNumberInfo"),
                detail.alias("latestStatusDetail"),
                F.transform("h", scan).alias("scanEvents"),
                F.when(
                    kind == 1,
                    F.array(
                        F.struct(
                            F.lit("ESTIMATED_DELIVERY").alias("type"), announced.alias("dateTime")
                        )
                    ),
                ).alias("dateAndTimes"),
            )
        ).alias("trackResults"),
    )
    flat = F.struct(
        number.alias("trackingNumber"),
        last["code"].alias("code"),
        last["status"].alias("statusByLocale"),
        last["description"].alias("description"),
    )
    return per_user.select(
        "capture", "part", "user_id", "kind", result.alias("result"), flat.alias("flat")
    )


def body_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies as JSON text with the columns that order them.

    Deep users share batch bodies of up to 30, every other one without the ``output``
    wrapper; flat users have a body each.
    """
    kind = F.col("kind")
    groups = (
        packages(spark, sf_dir)
        .groupBy("capture", "part")
        .agg(
            F.collect_list(F.when(kind < 4, F.col("result"))).alias("results"),
            F.collect_list(F.when(kind == 4, F.struct("user_id", "flat"))).alias("flats"),
        )
    )
    results = F.col("results")
    transaction = F.concat(F.lit("tx-"), F.col("part").cast("string"))
    output = F.struct(results.alias("completeTrackResults"))
    wrapped = F.to_json(F.struct(transaction.alias("transactionId"), output.alias("output")))
    text = F.when(F.col("part") % 2 == 0, wrapped).otherwise(F.to_json(output))
    deep = F.when(
        F.size(results) > 0, F.array(_body(F.lit(0), F.col("part"), text))
    ).otherwise(F.array().cast("array<struct<kind:int,part:bigint,text:string>>"))
    flat = F.transform("flats", lambda x: _body(F.lit(1), x["user_id"], F.to_json(x["flat"])))
    return groups.select("capture", F.concat(deep, flat).alias("b")).select(
        "capture", F.inline_outer("b")
    )


def _body(kind: Column, part: Column, text: Column) -> Column:
    return F.struct(kind.alias("kind"), part.alias("part"), text.alias("text"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return body_texts(spark, sf_dir).select(
        *BODY_ORDER, F.parse_json("text").alias("body")
    )
