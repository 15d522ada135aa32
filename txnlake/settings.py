"""Job parameters: where the tables are and what counts as an anomaly."""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

DEFAULT_THRESHOLD = 1000.0
DEFAULT_DATASET = "txn_lake"


@dataclass(frozen=True)
class Tables:
    """Names and locations of the tables inside one dataset folder.

    In the catalog they stand in `database`, by default one that is named after
    the folder. Next to the two tables are the summaries of `transactions`, named
    after it.
    """

    dataset: str = DEFAULT_DATASET
    transactions: str = "transactions"
    anomalies: str = "anomalies"
    database: str | None = None

    @property
    def catalog_database(self) -> str:
        return self.database or "txn_" + hashlib.sha1(self.dataset.rstrip("/").encode()).hexdigest()[:12]

    def name(self, table: str) -> str:
        """A table's full name, quoted for SQL."""
        return f"`{self.catalog_database}`.`{table}`"

    def path(self, table: str) -> str:
        return f"{self.dataset.rstrip('/')}/{table}"

    @property
    def transactions_path(self) -> str:
        return self.path(self.transactions)

    @property
    def anomalies_path(self) -> str:
        return self.path(self.anomalies)

    @property
    def by_hour(self) -> str:
        return f"{self.transactions}_by_hour"

    @property
    def by_user(self) -> str:
        return f"{self.transactions}_by_user"

    @classmethod
    def from_env(cls) -> "Tables":
        return cls(
            os.getenv("TXN_DATASET", cls.dataset),
            os.getenv("TXN_TRANSACTIONS_TABLE", cls.transactions),
            os.getenv("TXN_ANOMALIES_TABLE", cls.anomalies),
            os.getenv("TXN_DATABASE"),
        )


def threshold_from_env() -> float:
    return float(os.getenv("ANOMALY_AMOUNT_THRESHOLD", str(DEFAULT_THRESHOLD)))


def input_path_from_env() -> str | None:
    return os.getenv("INPUT_PATH")
