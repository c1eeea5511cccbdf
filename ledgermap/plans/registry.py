"""All datasets by name, with the sort that their files are written in."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgermap.plans import contracts, jobcost, ledger, masters, payables, receivables, reports
from ledgermap.plans.common import Tables, verbatim_header
from ledgermap.plans.summary import AREA, SUMMARY, with_summary
from ledgermap.sources.sink import ImportJob, Outcome, generate_imports
from ledgermap.sources.tables import Params
from ledgermap.sources.workspace import clear


@dataclass(frozen=True)
class Dataset:
    """``order_by`` names output columns; ``sorted_by_helper`` asks the builder for its own sort columns."""

    build: Callable[..., DataFrame]
    order_by: Sequence[str] = ()
    sorted_by_helper: bool = False
    helpers: Sequence[str] = ()

DATASETS: dict[str, Dataset] = {
    "import_gl_base_account": Dataset(masters.import_gl_base_account),
    "import_employees": Dataset(masters.import_employees, ["DONOTIMPORT_03", "LEGACY_EMPLOYEE_ID"]),
    "import_bank_accounts": Dataset(masters.import_bank_accounts, ["DONOTIMPORT_01", "DONOTIMPORT_02", "ACCOUNT_ID"]),
    "import_open_cash": Dataset(masters.import_open_cash),
    "import_customers": Dataset(masters.import_customers),
    "import_vendors": Dataset(masters.import_vendors),
    "import_vendors_ach": Dataset(masters.import_vendors_ach),
    "import_vendor_1099": Dataset(masters.import_vendor_1099),
    "import_projects": Dataset(masters.import_projects),
    "import_standard_cost_types": Dataset(masters.import_standard_cost_types, ["DONOTIMPORT_01", "LEGACY_ID"]),
    "import_standard_cost_codes": Dataset(masters.import_standard_cost_codes, sorted_by_helper=True),
    "import_cost_types": Dataset(masters.import_cost_types),
    "import_cost_codes": Dataset(masters.import_cost_codes),
    "import_open_ap": Dataset(payables.import_open_ap, sorted_by_helper=True),
    "import_open_ar": Dataset(receivables.import_open_ar, sorted_by_helper=True),
    "import_contract_header": Dataset(contracts.import_contract_header),
    "import_contract_lines": Dataset(contracts.import_contract_lines),
    "import_project_estimates": Dataset(
        contracts.import_project_estimates, ["PJESTIMATEENTRY_PROJECTID", "PJESTIMATEENTRY_LINENO"]
    ),
    "import_gl_opening": Dataset(ledger.import_gl_opening, sorted_by_helper=True),
    "import_gl_monthly": Dataset(ledger.import_gl_monthly, sorted_by_helper=True),
    "import_gl_detail": Dataset(ledger.import_gl_detail, sorted_by_helper=True),
    "import_jtd_cost": Dataset(jobcost.import_jtd_cost, ["DONOTIMPORT_01", "DONOTIMPORT_09", "LINE_NO"]),
    "api_jtd_cost": Dataset(jobcost.api_jtd_cost, ["DONOTIMPORT_01", "DONOTIMPORT_09", "LINE_NO"]),
    "report_gl_batch_outage": Dataset(reports.report_gl_batch_outage, ["Data_Folder_Id", "Batch", "Period"]),
    "report_open_ar_aging": Dataset(
        receivables.report_open_ar_aging, ["is_total", "Customer", "Invoice"], helpers=["is_total"]
    ),
    "report_job_summary": Dataset(reports.report_job_summary, ["DATA_FOLDER_ID", "JOB_ID"]),
}

# Kept for comparison with earlier runs; not written by ``run_all``.
ARCHIVED: dict[str, Dataset] = {
    "ar_activity_by_basis": Dataset(receivables.ar_activity_by_basis),
    "open_ar_flat": Dataset(receivables.open_ar_flat),
    "open_ar_project": Dataset(receivables.open_ar_project),
    "gl_detail_flat": Dataset(ledger.gl_detail_flat, sorted_by_helper=True),
}


def run_all(src: Tables, maps: Tables, params: Params, out_dir: str) -> list[Outcome]:
    """Write every current dataset below ``out_dir``.

    The coarse ledger datasets share one summary of the ledger; the detail reads its own months.
    """
    shared = with_summary(src, params)

    def job(dataset: Dataset) -> ImportJob:
        options = {"sort_columns": True} if dataset.sorted_by_helper else {}
        return ImportJob(
            lambda: dataset.build(shared, maps, params, **options), verbatim_header, dataset.order_by, dataset.helpers
        )

    try:
        return generate_imports({name: job(d) for name, d in DATASETS.items()}, out_dir)
    finally:
        clear(shared[SUMMARY].sparkSession, AREA)
