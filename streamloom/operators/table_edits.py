"""Inserts, updates and deletes as snapshot-to-snapshot transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def insert_row(df: DataFrame, **values) -> DataFrame:
    """The snapshot plus one row; columns not named are NULL."""
    row = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.unionByName(df.sparkSession.range(1).select(*row))


def update_where(df: DataFrame, condition: Column, **values) -> DataFrame:
    """Rows that meet the condition get new values; a NULL condition changes nothing."""
    return df.withColumns(
        {name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition go; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_in(df: DataFrame, key: str, gone: DataFrame, gone_key: str) -> DataFrame:
    """Rows whose key is listed go; the list is thinned to its keys first, so a key listed often costs no more."""
    keys = gone.select(F.col(gone_key).alias("__gone")).distinct()
    return df.join(keys, df[key] == F.col("__gone"), "left_anti")


def insert_overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_purchases(
    purchases: DataFrame, books: DataFrame, users: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Settle ``purchases(user_id, book_id)``: stock − 1 per purchase, balance − price.

    Purchases are counted per user and book before prices are joined, so a bestseller is one row per buyer.
    """
    bought = purchases.groupBy("user_id", "book_id").agg(F.count(F.lit(1)).alias("copies"))
    sold = bought.groupBy("book_id").agg(F.sum("copies").alias("sold"))
    spent = (
        bought.join(books.select("book_id", "price"), "book_id")
        .groupBy("user_id").agg(F.sum(F.col("copies") * F.col("price")).alias("spent"))
    )
    stock = books.join(sold, "book_id", "left").withColumn("stock", F.col("stock") - F.coalesce("sold", F.lit(0)))
    balance = users.join(spent, "user_id", "left").withColumn("balance", F.col("balance") - F.coalesce("spent", F.lit(0)))
    return stock.drop("sold"), balance.drop("spent")
