"""A card feed derived from the order table, for the registered queries.

Every order gives one record; rules on its key decide type, damage and gaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardweave.storage import folder_in_task

TOPIC = "rtf"
KEY_TEXT = "0123456789abcdef"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Orders in one task at most, on average, when they are dealt out.
ROWS_PER_TASK = 250_000


def _spread(scan: DataFrame) -> DataFrame:
    """Deal the rows out where the scan has fewer splits than cores, or than its rows need.

    The rows grow tenfold when they become XML, and splits are cut by bytes and cannot divide a row
    group. A table of many files is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-scan.count() // ROWS_PER_TASK))
    return scan.repartition(tasks) if scan.rdd.getNumPartitions() < tasks else scan


def _leaf(name: str, text: Column) -> Column:
    """``<name>text</name>``, or nothing when the text is null."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>")), F.lit(""))


def fragment(k: Column, customer: Column, price: Column, status: Column, placed: Column) -> Column:
    cents = F.round(price * 100).cast("bigint")
    # The seventh kind is an absent element.
    kinds = F.array(*[F.lit(t) for t in ("TVN", "TCN", "ACN", "TAR", "tvn ", "XYZ")])
    message_type = F.get(kinds, (k % 7).cast("int"))
    record_type = F.when(k % 5 == 0, "OTHER").when(k % 5 == 1, " ptlfx ").otherwise("PTLFX")
    pan = F.when(k % 11 == 0, None).when(k % 13 == 0, "12").otherwise(
        F.concat(F.lit("4"), F.lpad(customer.cast("string"), 15, "0"))
    )
    amount = (
        F.when(k % 19 == 0, None)
        .when(k % 17 == 0, "N/A")
        .otherwise(
            F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
        )
    )
    currency = F.get(F.array(F.lit("NZD"), F.lit("AUD"), F.lit("USD")), (customer % 3).cast("int"))
    response = F.when(status == "F", "00").when(status == "O", "05").otherwise("91")
    moment = placed + F.make_dt_interval(secs=k % 86400)
    timestamp = F.concat(F.translate(moment.cast("string"), " ", "T"), F.when(k % 23 == 0, "Z").otherwise(""))
    body = F.concat(
        F.lit("<Data>"),
        _leaf("MessageType", message_type),
        _leaf("RecordType", record_type),
        _leaf("TransactionId", F.concat(F.lit("TXN-"), k.cast("string"))),
        _leaf("DigitalPan", pan),
        _leaf("Amount", amount),
        _leaf("CurrencyCode", currency),
        _leaf("ResponseCode", response),
        _leaf("Timestamp", timestamp),
    )
    damaged = (k % 29 == 0) | (k % 31 == 0)
    ending = F.when(k % 29 == 0, "").when(k % 31 == 0, "</Data>junk").otherwise("</Data>")
    # The body is written out once, so that its code stays small enough to be compiled.
    return (
        F.when(~damaged & (k % 37 == 0), None)
        .when(~damaged & (k % 41 == 0), "   ")
        .otherwise(F.concat(body, ending))
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's columns for every order.

    Order keys run from 0 without gaps, so the offset within partition ``k % 4`` is
    ``k div 4``: no numbering of a whole partition in one task.
    """
    orders = _spread(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    )
    k = F.col("o_orderkey")
    value = fragment(k, F.col("o_custkey"), F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderdate"))
    return orders.select(
        F.concat(F.lit("order-"), k.cast("string")).alias("key"),
        value.alias("value"),
        F.lit(TOPIC).alias("topic"),
        (k % 4).cast("int").alias("partition"),
        F.floor(k / 4).cast("bigint").alias("offset"),
    )


def exact_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One publishable message for every order, with values that are hard to carry unchanged."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    text = k.cast("string")
    transaction = (
        F.when(k % 3 == 0, _leaf("TransactionId", F.concat(F.lit("<![CDATA[<amount>"), text, F.lit("</p:Amount>]]>"))))
        .when(k % 3 == 1, _leaf("TransactionId", F.concat(F.lit("TXN-"), text)))
        .otherwise(F.concat(F.lit("<transactionid>"), text, F.lit("</transactionid><!-- <TransactionId> -->")))
    )
    number = (
        F.when(k % 4 == 0, F.concat(F.lit("12345678901234567890"), F.lpad(text, 9, "0"), F.lit(".10")))
        .when(k % 4 == 1, F.concat(c, F.lit(".12345678901")))
        .when(k % 4 == 2, F.concat(c, F.lit(".50")))
        .otherwise(F.concat((1 + k % 9).cast("string"), F.lit("e2147483600")))
    )
    amount = F.when(k % 5 == 4, F.concat(F.lit('<Amount a="1" xmlns="urn:x">'), number, F.lit("</Amount >"))).otherwise(
        _leaf("Amount", number)
    )
    day = F.substring((F.col("o_orderdate")).cast("string"), 1, 10)
    moment = F.concat(day, F.lit("T01:02:03."), F.lpad((k % 1000000).cast("string"), 6, "0"), F.lit("789"))
    value = F.concat(
        F.lit('<Data xmlns:p="urn:p">'),
        _leaf("MessageType", F.lit("TVN")),
        _leaf("RecordType", F.lit("PTLFX")),
        transaction,
        amount,
        F.lit('<Timestamp xmlns="urn:x"/>'),
        _leaf("Timestamp", moment),
        F.lit("</Data>"),
    )
    orders = _spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    return orders.select(
        F.lit(None).cast("string").alias("key"), value.alias("value"), F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"), k.alias("offset"),
    )


def order_key(transaction_id: Column) -> Column:
    return F.substring(transaction_id, 5, 20).cast("bigint")


def customer_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token table: nine in ten customers, some of them twice."""
    c = F.col("c_custkey")
    copies = F.when(c % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        table(spark, sf_dir, "customer")
        .filter(c % 10 != 0)
        .select(
            F.concat(F.lit("4"), F.lpad(c.cast("string"), 15, "0")).alias("digital_pan"),
            F.concat(F.lit("TOK-"), c.cast("string")).alias("tokenised_pan"),
            F.explode(copies).alias("_copy"),
        )
        .drop("_copy")
    )


def supplier_feed(spark: SparkSession, sf_dir: str, blank: str) -> DataFrame:
    """One message per supplier, by the same rules, for the folder sources.

    ``blank`` stands for the null values, since a file always has content.
    """
    k = F.col("s_suppkey")
    value = fragment(k, k, F.abs("s_acctbal"), F.lit("F"), F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("msg."), k.cast("string")).alias("key"), F.coalesce(value, F.lit(blank)).alias("value")
    )


def set_time(spark: SparkSession, file: str, seconds: int) -> None:
    """Give a file the modification time ``seconds`` after 1970."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(path, seconds * 1000, -1)


def write_files(records: DataFrame, folder: str, extension: str = "xml") -> None:
    """Write each record as one file named after its key, from the tasks that hold them."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, path = folder_in_task(folder)
        filesystem.create_dir(path, recursive=True)
        for batch in batches:
            for key, value in zip(batch["key"], batch["value"], strict=True):
                with filesystem.open_output_stream(f"{path}/{key}.{extension}") as out:
                    out.write(value.encode("utf-8"))
            yield pd.DataFrame({"files": [len(batch)]})

    records.select("key", "value").mapInPandas(write, "files BIGINT").agg(F.sum("files")).collect()
