"""End-to-end assemblies (L1-L6) over the given tables.

`Pipeline` keeps the chain of stages. Each stored stage is written once as Parquet under the shared folder and read
back (A6): later stages start from the stored table, a lost executor does not send the job back to the raw tables, and
joins know the tables' sizes. Rows are counted by an `Observation` while a stage is written, so table status and
reconciliation read nothing again. With `store=False` every stage stays a lazy DataFrame.

Disk: a stage's shuffle files go when it is written. What ranks the line items is a stage of its own (raw rows, category
answers, service lines), so its shuffle is gone before the join that follows. Those stages and the join of the wide rows
with their answers are written slice by slice of the orders, a folder each, so only a slice's shuffle is held at a time.
`keep_marts` deletes what only the marts were made from.

`refresh_staging` and `refresh_fact` are the incremental builds (L4, L6) over partitioned tables.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from groundwork.operators import categorize as cat
from groundwork.operators import correct as corr
from groundwork.operators import extract, incremental, marts, staging
from groundwork.plans.sizing import DEFAULT_MAX_ROWS
from groundwork.session import shared_path, shuffles_dropped
from groundwork.sources import files, fixture
from groundwork.sources.tables import Table

AS_OF = marts.AS_OF
RUN_TS = marts.RUN_TS
SLICE_ORDERS, MAX_SLICES = 200_000, 3  # orders of a slice; no more slices, as each reads the line items again
BEFORE_ML = {"raw": "raw_work_orders", "corrected": None, "corrected_builders": "corrected_builders", "category_answers": "category_answers",
             "categories": None}
BEFORE_MARTS = BEFORE_ML | {"with_ml": "raw_work_orders_with_ml", "staging": "stg_work_orders"}


@dataclass
class Pipeline:
    spark: SparkSession
    sf_dir: str
    as_of: _dt.date = AS_OF
    run_ts: _dt.datetime = RUN_TS
    max_dist: int = 2
    store: bool = True
    counts: dict = field(default_factory=dict)
    _cache: dict = field(default_factory=dict)
    _folder: str = ""

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        """Write a stage, count its rows on the way, and read it back."""
        if not self.store:
            return df
        self.counts[name] = self._write(df, name)
        return self.spark.read.schema(df.schema).parquet(f"{self._folder}/{name}")

    def _write(self, df: DataFrame, name: str) -> int:
        if not self._folder:
            self._folder = shared_path(self.spark, f"run-{uuid.uuid4().hex}")
        seen = Observation(name)
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        with shuffles_dropped(self.spark):
            counted.write.mode("errorifexists").option("compression", "zstd").parquet(f"{self._folder}/{name}")
        return seen.get["rows"]

    def _stored_in_slices(self, name: str, parts: list[DataFrame]) -> DataFrame:
        """A stage whose parts are written one after the other, a partition folder each."""
        self.counts[name] = sum(self._write(df, f"{name}/slice={i}") for i, df in enumerate(parts))
        return self.spark.read.schema(parts[0].schema).parquet(*[f"{self._folder}/{name}/slice={i}" for i in range(len(parts))])

    def _slices(self) -> int:
        orders = self._memo("orders", lambda: fixture.read(self.spark, self.sf_dir, "orders").count())  # from the files' footers
        return max(1, min(MAX_SLICES, -(-orders // SLICE_ORDERS)))

    def _of_orders(self, name: str, build: Callable[[fixture.Slice | None], DataFrame]) -> DataFrame:
        """Store a table of the orders' lines slice by slice of the orders."""
        if not self.store:
            return build(None)
        n = self._slices()
        return self._stored_in_slices(name, [build(fixture.Slice(i, n)) for i in range(n)])

    def _slice(self, name: str, whole: DataFrame, i: int) -> DataFrame:
        return self.spark.read.schema(whole.schema).parquet(f"{self._folder}/{name}/slice={i}")

    def _small(self, name: str, df: DataFrame) -> DataFrame:
        """A stored stage, marked for broadcast when it has few rows."""
        stored = self._stored(name, df)
        return F.broadcast(stored) if self.counts.get(name, DEFAULT_MAX_ROWS + 1) <= DEFAULT_MAX_ROWS else stored

    def keep_marts(self) -> None:
        """Delete the stored stages that only the fact and its dimensions were made from; each is made again if it is asked for."""
        self.fact()
        self._release(BEFORE_MARTS)

    def keep_ml(self) -> None:
        """The same for what only the categorized rows were made from."""
        self.with_ml()
        self._release(BEFORE_ML)

    def _release(self, stages: dict[str, str | None]) -> None:
        for memo, name in stages.items():
            if self._folder and name:
                files.remove(self.spark, f"{self._folder}/{name}")
            self._cache.pop(memo, None)

    def drop(self) -> None:
        """Delete what this run stored."""
        if self._folder:
            files.remove(self.spark, self._folder)
            self._folder = ""
        self._cache.clear()

    def _memo(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    # L1
    def raw_from_answers(self) -> DataFrame:
        return self._memo("raw_from_answers",
                          lambda: extract.to_raw_row(fixture.answer_texts(self.spark, self.sf_dir)))

    def raw(self) -> DataFrame:
        return self._memo("raw", lambda: self._of_orders("raw_work_orders", lambda part: extract.to_raw_row(
            fixture.answer_texts(self.spark, self.sf_dir, part))))

    def read_documents(self, docs: DataFrame, model: Callable[[bytes, str], str | None]) -> DataFrame:
        """The model's answer or its error for each document, stored once since both halves of L1 read it."""
        return self._stored(f"answers_{uuid.uuid4().hex}", extract.apply_model(docs, model, "content", "file_url"))

    @staticmethod
    def raw_and_rejects(answered: DataFrame) -> tuple[DataFrame, DataFrame]:
        """L1: raw rows of the documents with an answer, and the documents without one and why."""
        ok = F.col("answer_text").isNotNull()
        return extract.to_raw_row(answered.where(ok)), answered.where(~ok).drop("answer_text")

    def dictionary(self) -> DataFrame:
        return self._memo("dictionary", lambda: fixture.builder_dictionary(self.spark, self.sf_dir))

    # L2
    def corrected(self) -> DataFrame:
        return self._memo("corrected", lambda: self._correct(self.raw()))

    def _correct(self, raw: DataFrame) -> DataFrame:
        """The correction of raw rows; the answers of all raw rows' names, found by the first call, serve every slice."""
        return corr.correct(raw, self.dictionary(), self.run_ts, self.max_dist, lambda found: self._memo(
            "corrected_builders", lambda: self._small("corrected_builders", found)))

    # L3
    def category_answers(self) -> DataFrame:
        return self._memo("category_answers", lambda: self._of_orders(
            "category_answers", lambda part: fixture.category_answers(self.spark, self.sf_dir, part)))

    def categories(self) -> DataFrame:
        return self._memo("categories", lambda: cat.categorize(self.corrected(), answers=self.category_answers()))

    def with_ml(self) -> DataFrame:
        """The corrected rows with their categories (equal to update_column(corrected, categories())); they are counted on the way.

        Rows and answers of an order are in one slice, so the slices' joins find what the whole one does.
        """
        def build():
            corrected, answers, name = self.corrected(), self.category_answers(), "raw_work_orders_with_ml"
            if not self.store:
                return cat.with_categories(corrected, answers=answers)
            seen = []

            def part(i: int) -> DataFrame:
                seen.append(Observation(f"raw_work_orders_corrected_{i}"))
                rows = self._correct(self._slice("raw_work_orders", self.raw(), i)).observe(seen[-1], F.count(F.lit(1)).alias("rows"))
                return cat.with_categories(rows, answers=self._slice("category_answers", answers, i))

            out = self._stored_in_slices(name, [part(i) for i in range(self._slices())])
            self.counts["raw_work_orders_corrected"] = sum(s.get["rows"] for s in seen)
            return out
        return self._memo("with_ml", build)

    # L4
    def staging(self) -> DataFrame:
        return self._memo("staging", lambda: self._stored("stg_work_orders", staging.stage(self.with_ml(), self.run_ts)))

    # L5
    def dim_builders(self) -> DataFrame:
        return self._memo("dim_builders", lambda: self._stored("dim_builders", marts.dim_builders(
            self.staging(), self.dictionary(), self.as_of, self.run_ts)))

    def dim_projects(self) -> DataFrame:
        return self._memo("dim_projects", lambda: self._stored("dim_projects", marts.dim_projects(self.staging(), self.run_ts)))

    def dim_companies(self) -> DataFrame:
        return self._memo("dim_companies", lambda: self._stored("dim_companies", marts.dim_companies(self.staging(), self.run_ts)))

    # L6
    def fact(self) -> DataFrame:
        return self._memo("fact", lambda: self._stored("fct_work_orders", marts.fact(
            self.staging(), self.dim_builders(), self.dim_projects(), self.dim_companies(), self.run_ts)))

    def service_lines(self) -> DataFrame:
        return self._memo("service_lines", lambda: marts.fct_service_lines(
            self.fact(), self._of_orders("service_line_source", lambda part: fixture.service_line_source(self.spark, self.sf_dir, part))))

    def dim_builders_conformed(self) -> DataFrame:
        return self._memo("dbc", lambda: marts.dim_builders_conformed(self.fact(), self.dim_builders(),
                                                                      self.as_of))

    TABLES = ("raw_work_orders", "raw_work_orders_corrected", "raw_work_orders_with_ml", "stg_work_orders",
              "dim_builders", "dim_projects", "dim_companies", "fct_work_orders")

    def row_counts(self) -> dict[str, int | None]:
        """Rows of every table of the run (D13, D14), gathered while they were written."""
        self.fact()
        return {name: self.counts.get(name) for name in self.TABLES}

    # L4, L6 incremental
    def staging_table(self, path: str, grain: str = "day") -> Table:
        return Table(self.spark, path, "work_order_id", "extracted_at", "extracted_at", grain, ("builder_name", "project_name"))

    def fact_table(self, path: str) -> Table:
        return Table(self.spark, path, "work_order_id", "extracted_at", "work_date", "month",
                     ("builder_key", "project_key", "company_key"))

    def refresh_staging(self, table: Table, with_ml: DataFrame) -> list[str]:
        """L4: rows newer than the table's mark (B3) are staged and merged; the first run takes all."""
        held = table.read() if table.exists() else None
        return table.merge(staging.stage(incremental.newer_than(with_ml, held, "extracted_at"), self.run_ts))

    def refresh_fact(self, table: Table, stg: DataFrame, db: DataFrame, dp: DataFrame, dc: DataFrame) -> list[str]:
        """Staged rows newer than the fact's mark get their keys and are merged into their months."""
        held = table.read() if table.exists() else None
        return table.merge(marts.fact(incremental.newer_than(stg, held, "extracted_at"), db, dp, dc, self.run_ts))
