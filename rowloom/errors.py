"""Exceptions raised by the operators."""

from __future__ import annotations


class RuleError(ValueError):
    """A quality-rule string that does not follow the rule grammar."""

    def __init__(self, rule: str, reason: str) -> None:
        super().__init__(f"quality rule {rule!r}: {reason}")
        self.rule = rule
        self.reason = reason


class QualityError(RuntimeError):
    """A blocking quality rule failed.

    ``report`` holds the whole report, one dict per rule, so a caller can log
    or store it.
    """

    def __init__(self, report: list[dict]) -> None:
        self.report = report
        self.failed = [
            line for line in report if not line["passed"] and line["on_failure"] == "block"
        ]
        summary = "; ".join(
            f"{line['rule']}({line['column']}): {line['failed_rows']} of {line['total_rows']} rows"
            for line in self.failed
        )
        super().__init__(f"blocking quality rules failed: {summary}")


class ValidationError(RuntimeError):
    """A blocking ``validate`` check did not hold."""
