"""The tables the registered queries start from, derived from one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, features, labels, ledger, trailing
from ..sources import standins


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return standins.table(self.spark, self.sf_dir, name)

    def feed(self, name: str) -> DataFrame:
        return standins.FEEDS[name](self.spark, self.sf_dir)

    @cached_property
    def silver_loans(self) -> DataFrame:
        return ledger.silver_loan_daily(self.feed("loan_daily"))

    @cached_property
    def labels(self) -> DataFrame:
        return labels.label_store(self.silver_loans)

    @cached_property
    def silver_attributes(self) -> DataFrame:
        return cleaning.silver_attributes(self.feed("attributes"))

    @cached_property
    def typed_financials(self) -> DataFrame:
        return cleaning.typed_financials(self.feed("financials"))

    @cached_property
    def reconciled(self) -> DataFrame:
        return cleaning.reconcile_loans(self.typed_financials)

    @cached_property
    def silver_financials(self) -> DataFrame:
        return cleaning.silver_financials(self.feed("financials"))

    @cached_property
    def silver_clicks(self) -> DataFrame:
        return cleaning.silver_clickstream(self.feed("clickstream"))

    @cached_property
    def gold_attributes(self) -> DataFrame:
        return features.gold_attributes(self.silver_attributes)

    @cached_property
    def gold_financials(self) -> DataFrame:
        return features.gold_financials(self.silver_financials)

    @cached_property
    def gold_clicks(self) -> DataFrame:
        return trailing.gold_clickstream(self.silver_clicks)

    @cached_property
    def feature_store(self) -> DataFrame:
        return features.feature_store(self.silver_attributes, self.silver_financials, self.silver_clicks)
