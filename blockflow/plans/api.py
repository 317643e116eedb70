"""The explorer's routes as functions: a path and its parameters in, a status and JSON rows out.

Numbers that can't be read count as not given, but a block's round in the path must be one (400) and exist (404).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from blockflow.operators import explorer as X


class Explorer:
    """Answers over tables of blocks and transactions (with intra), a checkpoint, and balances if there are any."""

    def __init__(self, blocks: DataFrame, transactions: DataFrame, checkpoint: int | None, balances: DataFrame | None = None) -> None:
        self.blocks, self.transactions, self.checkpoint, self.balances = blocks, transactions, checkpoint, balances

    def frame(self, path: str, params: dict[str, str]) -> DataFrame:
        """The rows of a route; KeyError for a path that isn't one."""
        get = params.get
        limit = get("limit", "")
        routes = {
            "/api/status": lambda: X.status(self.blocks, self.transactions, self.checkpoint),
            "/api/blocks": lambda: X.recent_blocks(self.blocks, limit, get("before", "")),
            "/api/transactions": lambda: X.recent_transactions(self.transactions, limit, get("round", ""), get("sender", ""), get("app_id", "")),
            "/api/senders": lambda: self._senders(limit),
            "/api/apps": lambda: X.top_apps(self.transactions, limit),
            "/api/busy-blocks": lambda: X.busy_blocks(self.blocks, limit),
        }
        return routes[path]()

    def _senders(self, limit: str) -> DataFrame:
        top = X.top_senders(self.transactions, limit)
        return X.with_balances(top, self.balances) if self.balances is not None else top

    def get(self, path: str, params: dict[str, str] | None = None) -> tuple[int, object]:
        """(status, what is sent as JSON). Lists are pages of at most 200 rows."""
        head, _, last = path.rpartition("/")
        if head == "/api/blocks":
            if not last.isdigit():
                return 400, {"error": "invalid round"}
            rows = self._json(X.block_by_round(self.blocks, int(last)))
            if not rows:
                return 404, {"error": "block not found"}
            return 200, rows[0] | {"transactions": self._json(X.recent_transactions(self.transactions, 200, last))}
        try:
            rows = self._json(self.frame(path, params or {}))
        except KeyError:
            return 404, {"error": "no such route"}
        return 200, rows[0] if path == "/api/status" else rows

    def _json(self, df: DataFrame) -> list[dict]:
        return [{k: v for k, v in json.loads(r[0]).items() if not (k == "app_id" and v == 0)} for r in X.as_json(df).collect()]
