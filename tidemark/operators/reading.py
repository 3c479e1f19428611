"""Reading archived payloads once for each version of the rules.

A reading is named by five parts: the payload's digest, what it is read as, and the versions of the parser, the contract and the text contract. Only payloads
without a complete reading of that name reach the parser; one that failed is read again, as nothing is known of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import Contracts

KEY = ("sha256", "kind", "parser", "contract", "text_contract")


def named(payloads: DataFrame, kind: str, contracts: Contracts) -> DataFrame:
    """The payloads with the five parts of their reading's name."""
    parts = {"kind": kind, "parser": contracts.parser, "contract": contracts.contract, "text_contract": contracts.text_contract}
    return payloads.withColumns({k: F.lit(v) for k, v in parts.items()})


def unread(payloads: DataFrame, memo: DataFrame | None, kind: str, contracts: Contracts) -> DataFrame:
    """The payloads (sha256 and others; equal digests once) that have no complete reading under these versions."""
    wanted = named(payloads, kind, contracts).dropDuplicates(["sha256"])
    return wanted if memo is None else wanted.join(memo.where("status <> 'failed'").select(*KEY), list(KEY), "left_anti")


def readings(payloads: DataFrame, memo: DataFrame | None, kind: str, contracts: Contracts, parse: Callable[[], Column]) -> DataFrame:
    """New rows of the memo: the five parts, status and result (the parser's struct, which has a status), of what is unread."""
    rows = unread(payloads, memo, kind, contracts).withColumn("result", parse())
    return rows.select(*KEY, F.col("result.status").alias("status"), "result")


def remembered(memo: DataFrame | None, new: DataFrame) -> DataFrame:
    """The memo with the new rows; a failed reading is replaced by the next one of its name."""
    if memo is None:
        return new
    return memo.join(new.select(*KEY), list(KEY), "left_anti").unionByName(new)


def read_as(payloads: DataFrame, memo: DataFrame, kind: str, contracts: Contracts) -> DataFrame:
    """The payloads with status and result of their reading; null where there is none."""
    return named(payloads, kind, contracts).join(memo.select(*KEY, "status", "result"), list(KEY), "left")


def summary(new: DataFrame) -> DataFrame:
    """kind, parser, status, readings: what a run of reading has done."""
    return new.groupBy("kind", "parser", "status").agg(F.count("*").alias("readings"))
