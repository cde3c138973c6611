"""Typed report parameters.

``'%'`` means "all", as callers of the reports expect.  Wildcards are resolved
here, before a plan is built, so a plan never carries an ``'%' OR ...`` test.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from enum import IntEnum

ALL = "%"
HEAD_OFFICE = "CENTRAL"
UNRESTRICTED_USERS = (ALL, "ADMIN")


def code(value: str) -> str:
    """A code parameter in the form the code columns are stored in."""
    return value.strip().upper()


def code_list(value: str) -> list[str] | None:
    """The members of a comma-separated list, or None for "all"."""
    if value.strip() == ALL:
        return None
    return [code(part) for part in value.split(",")]


class ClaimKind(IntEnum):
    SALES = 0
    BRAND = 1
    ADMIN = 2
    TIE_UP = 3
    OUTLET = 4
    BREAKAGE = 5

    @classmethod
    def of(cls, number: int) -> "ClaimKind":
        """Every number without a layout of its own is the breakage report."""
        return cls(number) if number in set(cls) else cls.BREAKAGE


@dataclass(frozen=True)
class DashboardScope:
    """Who is looking, at which day, at which distributors."""

    date: dt.date
    type: str = ALL
    id: str = ALL
    distributor: str = ALL
    region: str = ALL
    #: count a company once even if the user has several accounts in it
    distinct_companies: bool = False

    @property
    def restricted(self) -> bool:
        return code(self.id) not in UNRESTRICTED_USERS


@dataclass(frozen=True)
class ClaimRequest:
    date1: dt.date
    date2: dt.date
    companyid: str = ALL
    acid: str = ALL
    #: a ClaimKind; without one each report shows its own default layout
    claimtype: int | None = None

    def kind(self, default: ClaimKind) -> ClaimKind:
        return default if self.claimtype is None else ClaimKind.of(self.claimtype)


@dataclass(frozen=True)
class OutletRequest:
    date1: dt.date
    date2: dt.date
    companyid: str = ALL


@dataclass(frozen=True)
class StockRequest:
    date1: dt.date
    date2: dt.date
    companyid: str = ALL
    pcl: str = "PC007"
    phiscalid: str = "82/83"
    acid: str = ALL
