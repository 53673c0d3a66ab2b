"""Run configuration: paths, table names and options as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PipelineConfig:
    landing: str                      # folder (or URI) where drops arrive
    output: str                       # root for marts, quarantine, staging
    ledger: str                       # ledger dataset path
    on_open_files: str = "reprocess"  # or "fail" (T13)
    jdbc_url: str | None = None       # optional JDBC sink for monthly marts
    jdbc_properties: dict = field(default_factory=dict)
    customer_monthly_table: str = "customers_data_mart"
    sales_team_monthly_table: str = "sales_team_data_mart"
    incentive_rate: str = "0.01"
    header_method: str = "auto"       # "sniff", "scan" or "auto"
    preview: bool = False             # SNK-8 show() of each stage
    processed_dir: str | None = None  # SNK-10: move consumed files here
    error_dir: str | None = None      # SNK-9: move rejected files here
    monthly_report_csv: bool = True   # EXT-1: per-month CSV incentive report

    compact_ledger: bool = False      # SNK-6/7: snapshot the ledger's state after a run
    check_dimensions: str = "off"     # "report" or "fail": shapes and keys of the dimensions

    def path(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"
