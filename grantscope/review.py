"""One review run: findings computed once, every summary and view served from them.

The original tool computed findings once per run and derived its summary,
dashboard pages and evidence from that single result. ``Review`` does the
same at scale: the findings are written once as a Parquet table in the
shared folder (a lineage cut that survives executor loss) and every output
reads that table instead of re-running the detection joins.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope import schemas
from grantscope.operators import evidence as E
from grantscope.operators import summary as S
from grantscope.operators import views as V
from grantscope.operators.findings import build_findings, sort_by_risk
from grantscope.session import exists, shared_dir
from grantscope.sources import sinks


#: Rows that a step towards a deep page passes at most.
MAX_STEP = 6_000


class Review:
    def __init__(self, spark: SparkSession, employees: DataFrame, access: DataFrame, as_of: str,
                 params: cat.RuleParams = cat.RuleParams(), location: str | None = None):
        self.spark = spark
        self.employees = employees
        self.access = access
        self.as_of = as_of
        self.params = params
        self.location = location or shared_dir(spark, "review")
        self._findings: DataFrame | None = None
        self._ranked: DataFrame | None = None
        self._page_ends: dict[tuple, dict[int, dict]] = {}

    # ── the one expensive step ──────────────────────────────────────────
    def findings(self) -> DataFrame:
        """Findings of all rules, written once under ``location`` and read back.

        The folder is named after the review time, the parameters and a fingerprint of both tables, so changed tables are
        reviewed anew. A finished table (``_SUCCESS``) of an
        earlier run at the same location is read; an unfinished one is written anew.
        """
        if self._findings is None:
            run = hashlib.sha256(f"{self.as_of}|{self.params}|{self._fingerprint()}".encode()).hexdigest()[:12]
            path = f"{self.location}/findings-{run}.parquet"
            if exists(self.spark, f"{path}/_SUCCESS"):
                self._findings = self.spark.read.schema(schemas.FINDINGS).parquet(path)
            else:
                f = build_findings(self.employees, self.access, self.as_of, self.params)
                self._findings = sinks.write_parquet(f, path, "overwrite")
        return self._findings

    def _fingerprint(self) -> str:
        """Rows of both tables and the sums of their hashes: the same for the same rows in any order."""
        def of(df):
            row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
            return tuple(df.agg(F.count(F.lit(1)), F.sum(row_hash)).first())
        return f"{of(self.employees)}|{of(self.access)}"

    def ranked(self) -> DataFrame:
        """The findings with their ranks, stored once."""
        if self._ranked is None:
            self._ranked = V.store_ranked(self.findings(), shared_dir(self.spark, "ranked"))
        return self._ranked

    # ── everything else reads the stored findings ───────────────────────
    def sorted(self) -> DataFrame:
        return sort_by_risk(self.findings())

    def kpis(self) -> DataFrame:
        return S.kpis(self.findings(), self.employees, self.access)

    def summary(self) -> DataFrame:
        """One row: the KPIs and the count maps by severity, type, department and top systems."""
        return E.summary_meta(self.findings(), self.employees, self.access, self.as_of, with_maps=True)

    def by(self, column: str) -> DataFrame:
        return S.value_counts(self.findings(), column)

    def top(self, n: int = 10) -> DataFrame:
        return V.top_findings(self.findings(), n)

    def filtered(self, severity=None, department=None, finding_type=None, search: str | None = None) -> DataFrame:
        f = V.filter_findings(self.findings(), severity, department, finding_type)
        return V.search_findings(f, search) if search else f

    def page(self, page: int, per_page: int = cat.FINDINGS_PER_PAGE, **filters) -> DataFrame:
        """A page of the findings, by stored ranks; a page of filtered ones by the sort key of the page before it.

        Last rows of pages that were passed are remembered; a jump goes on in steps of at most
        ``MAX_STEP`` rows, so no task and no driver ever holds all the rows before a deep page.
        """
        if page < 1:
            raise ValueError("page starts at 1")
        if not filters:
            return V.ranked_page(self.ranked(), page, per_page).drop("page")
        found = self.filtered(**filters)
        ends = self._page_ends.setdefault((per_page, *sorted(filters.items())), {0: None})
        at = max(p for p in ends if p < page)
        while at < page - 1:
            step = min(page - 1 - at, max(1, MAX_STEP // per_page))
            last = V.findings_after(found, ends[at], step * per_page).select(*V.PAGE_KEY).tail(step * per_page)
            if len(last) < step * per_page:
                return found.limit(0)  # past the last page
            at += step
            ends[at] = last[-1].asDict()
        return V.findings_after(found, ends[at], per_page)

    def pages(self, per_page: int = cat.FINDINGS_PER_PAGE, **filters) -> int:
        """The number of pages, 1 at least."""
        return V.page_count(self.filtered(**filters), per_page).first()["n_pages"]

    def inventory(self, **filters) -> DataFrame:
        return V.access_inventory(self.access, self.employees, **filters)

    def evidence(self, out_dir: str | None = None, run_id: str | None = None) -> DataFrame:
        """Write the evidence package; the index lists the files and their row counts."""
        return E.write_evidence_package(self.spark, self.findings(), self.employees, self.access,
                                        out_dir or f"{self.location}/evidence", self.as_of, run_id)
