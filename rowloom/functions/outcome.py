"""Results that carry diagnostics beside the data (K4)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Reporter:
    """Counts what a Python function has to say while it works on its rows.

    ``warn`` and ``error`` count a text, ``add`` sums a number under a name.
    The texts and names are declared beforehand (``reported_batches``), since
    Spark gathers them as columns of fixed names; others are a ``KeyError``.
    """

    def __init__(self, warnings: Iterable[str], errors: Iterable[str], sums: Iterable[str]) -> None:
        self._kinds = {"warning": [*warnings], "error": [*errors], "sum": [*sums]}
        self.clear()

    def clear(self) -> None:
        self._values = {(kind, text): 0 for kind, texts in self._kinds.items() for text in texts}

    def _count(self, kind: str, text: str, amount) -> None:
        self._values[kind, text] += amount

    def warn(self, text: str, rows: int = 1) -> None:
        self._count("warning", text, rows)

    def error(self, text: str, rows: int = 1) -> None:
        self._count("error", text, rows)

    def add(self, name: str, amount: float) -> None:
        self._count("sum", name, amount)

    def values(self) -> list[float]:
        """The counts since ``clear``, in the order of declaration."""
        return [float(value) for value in self._values.values()]


class TaskOutcome:
    """K4: a DataFrame with diagnostics that are counted while it is computed.

    ``warnings`` and ``errors`` map a text to a row condition, ``metadata``
    maps a name to an aggregate (not DISTINCT, which Spark cannot observe).
    They ride along with the first action on ``df``, at no extra pass; reading
    them waits for that action.
    """

    @classmethod
    def of_reports(
        cls,
        df: DataFrame,
        reports: Column,
        is_row: Column,
        columns: list[Column],
        warnings: list[str],
        errors: list[str],
        sums: list[str],
    ) -> TaskOutcome:
        """Observe an array of counts that rides beside the rows, then show the rows alone."""
        outcome = cls.__new__(cls)
        outcome._warnings, outcome._errors, outcome._metadata = warnings, errors, sums
        outcome._observation = Observation()
        named = [("warning", warnings, "bigint"), ("error", errors, "bigint"), ("metadata", sums, "double")]
        metrics, place = [F.count_if(is_row).alias("row_count")], 0
        for prefix, texts, kind in named:
            for index in range(len(texts)):
                total = F.coalesce(F.sum(F.get(reports, F.lit(place))), F.lit(0.0))
                metrics.append(total.cast(kind).alias(f"{prefix}_{index}"))
                place += 1
        outcome.df = df.observe(outcome._observation, *metrics).filter(is_row).select(*columns)
        return outcome

    def __init__(
        self,
        df: DataFrame,
        warnings: Mapping[str, Column] | None = None,
        errors: Mapping[str, Column] | None = None,
        metadata: Mapping[str, Column] | None = None,
    ) -> None:
        self._warnings = list(warnings or {})
        self._errors = list(errors or {})
        self._metadata = list(metadata or {})
        self._observation = Observation()
        metrics = [F.count(F.lit(1)).alias("row_count")]
        for prefix, conditions in (("warning", warnings), ("error", errors)):
            metrics += [
                F.count_if(condition).alias(f"{prefix}_{index}")
                for index, condition in enumerate((conditions or {}).values())
            ]
        metrics += [
            value.alias(f"metadata_{index}") for index, value in enumerate((metadata or {}).values())
        ]
        self.df = df.observe(self._observation, *metrics)

    def _counted(self, prefix: str, texts: list[str]) -> dict[str, int]:
        values = self._observation.get
        counts = {text: values[f"{prefix}_{index}"] for index, text in enumerate(texts)}
        return {text: count for text, count in counts.items() if count}

    @property
    def warnings(self) -> dict[str, int]:
        """Warnings that occurred, with the number of rows concerned."""
        return self._counted("warning", self._warnings)

    @property
    def errors(self) -> dict[str, int]:
        """Errors that occurred, with the number of rows concerned."""
        return self._counted("error", self._errors)

    @property
    def has_warnings(self) -> bool:
        return bool(self.warnings)

    @property
    def has_errors(self) -> bool:
        return bool(self.errors)

    @property
    def metadata(self) -> dict:
        values = self._observation.get
        return {name: values[f"metadata_{index}"] for index, name in enumerate(self._metadata)}

    @property
    def row_count(self) -> int:
        return self._observation.get["row_count"]
