"""The few spellings in which the relation texts differ between Spark and DuckDB."""

from __future__ import annotations


class Spark:
    def text(self, x: str) -> str:
        return f"cast({x} as string)"

    def record(self, **fields: str) -> str:
        return "named_struct(" + self._pairs(fields) + ")"

    def array(self, *items: str) -> str:
        return "array(" + ", ".join(items) + ")"

    def document(self, **fields: str) -> str:
        return f"to_json({self.record(**fields)})"

    def rows(self, *items: str) -> str:
        """One output row per item."""
        return f"explode({self.array(*items)})"

    def instant(self, x: str) -> str:
        return f"timestamp_ntz '{x}'"

    @staticmethod
    def _pairs(fields: dict[str, str]) -> str:
        return ", ".join(f"'{name}', {value}" for name, value in fields.items())


class DuckDB(Spark):
    def text(self, x: str) -> str:
        return f"cast({x} as varchar)"

    def record(self, **fields: str) -> str:
        return "json_object(" + self._pairs(fields) + ")"

    def array(self, *items: str) -> str:
        return "json_array(" + ", ".join(items) + ")"

    def document(self, **fields: str) -> str:
        return f"cast({self.record(**fields)} as varchar)"

    def rows(self, *items: str) -> str:
        return "unnest([" + ", ".join(items) + "])"

    def instant(self, x: str) -> str:
        return f"timestamp '{x}'"
