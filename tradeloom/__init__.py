"""Trade-claims and distributor-sales analytics on Spark.

The package turns an ERP star schema (vouchers, lines, products, prices,
distributors, accounts, a sales hierarchy and a local calendar) into
parameterised reports.  Every report is a lazy DataFrame plan.
"""

from tradeloom.params import ClaimRequest, DashboardScope, OutletRequest, StockRequest
from tradeloom.report import Report
from tradeloom.session import configure

__all__ = [
    "ClaimRequest",
    "DashboardScope",
    "OutletRequest",
    "Report",
    "StockRequest",
    "configure",
]
