"""Lazy inputs of the registered queries, derived from one folder of supplied tables.

Nothing is collected or cached here: each property is a lazy DataFrame over the Parquet scans,
so every query's plan starts at the files and Catalyst prunes columns and pushes filters into
the scans.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from premiumlake.operators.ingest import clean_transactions, ingest_raw
from premiumlake.operators.party_marts import monthly_premiums
from premiumlake.operators.spine import daily_activity, user_months_from_policies
from premiumlake.sources import fixtures
from premiumlake.sources.files import read_table


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = fixtures.AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.raw_transactions(self.table("orders"))

    @cached_property
    def bronze(self) -> DataFrame:
        return ingest_raw(self.raw)

    @cached_property
    def silver(self) -> DataFrame:
        return clean_transactions(self.bronze)

    @cached_property
    def monthly(self) -> DataFrame:
        return monthly_premiums(self.silver)

    @cached_property
    def ledger(self) -> DataFrame:
        return fixtures.accounting_closing(self.silver)

    @cached_property
    def policies(self) -> DataFrame:
        return fixtures.policies(self.table("customer"), self.table("orders"))

    @cached_property
    def activity(self) -> DataFrame:
        return daily_activity(self.policies, self.as_of)

    @cached_property
    def user_months(self) -> DataFrame:
        return user_months_from_policies(self.policies, self.as_of)
