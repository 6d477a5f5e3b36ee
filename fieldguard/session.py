"""Live hosts: one checked configuration, activated and probed once, behind every transform."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession

from .activation import activate
from .config import OptionsError, bind_scan_config, verify_scan_options
from .operators.lines import redact_lines
from .operators.walk import Walk, mask_columns
from .operators.strict import Strict, sanitize_column
from .plans import hosts, strict
from .plans.ready import create_strict
from .sources.lines import read_redacted_lines, redacting_sink


class Sanitizer:
    """Transforms of one session. Options are checked, the personal-data switch is set and the detectors are probed here,
    so that nothing is left to fail when rows flow; what is wrong raises with a fixed code.

    options: scan options, or scan_config; limits (of walks), operation (of budgets), line_limits.
    """

    def __init__(self, spark: SparkSession, **options):
        bound = bind_scan_config(options)
        self.spark, self.config = spark, bound["scan_config"]
        self.identity = activate(spark, ["pii:global"] if self.config.pii else None)
        verify_scan_options(spark, self.config)
        self.walk = Walk(self.config, options.get("limits"), operation=options.get("operation"))
        self.line_limits = options.get("line_limits")

    def mask_secrets(self, df: DataFrame, *names: str, outcome: str | None = None) -> DataFrame:
        return mask_columns(df, *names, walk=self.walk, outcome=outcome)

    def redact_lines(self, df: DataFrame, line: str = "line", outcome: str | None = None) -> DataFrame:
        return redact_lines(df, line, self.config, self.line_limits, self.walk, outcome=outcome)

    def redact_log_calls(self, df: DataFrame, **names) -> DataFrame:
        return hosts.redact_log_calls(df, walk=self.walk, **names)

    def redact_log_records(self, df: DataFrame, extra_fields: list[str] | None = None, outcome: str | None = None) -> DataFrame:
        return hosts.redact_log_records(df, extra_fields, self.walk, outcome)

    def redact_spans(self, df: DataFrame, outcome: str | None = None) -> DataFrame:
        return hosts.redact_spans(df, self.walk, outcome)

    def redact_otel_logs(self, df: DataFrame, outcome: str | None = None) -> DataFrame:
        return hosts.redact_otel_logs(df, Walk(self.config, self.walk.limits, key_context=False, operation=False, count_dropped=True), outcome)

    def strict(self, **options) -> Strict:
        """Checked rules of a boundary over the session's detectors; its policies are the session's, so options that would
        give it others are refused."""
        for name in ("evaluate", "formatter", "rules", "pii", "policy", "action_policy"):
            if options.get(name) is not None:
                raise OptionsError("CORE_OPTION_UNSUPPORTED", (name,))
        return replace(create_strict(None, **options), config=self.config)

    def sanitize(self, df: DataFrame, operation: str, value: Column, label: str = "user-input", into: str = "o", **options) -> DataFrame:
        return strict.sanitize(df, operation, value, self.strict(**options), label, into=into)

    def sanitize_column(self, df: DataFrame, name: str, outcome: str = "outcome", **options) -> DataFrame:
        return sanitize_column(df, name, self.strict(**options), outcome)

    def read_lines(self, path: str, stream: bool = False) -> DataFrame:
        return read_redacted_lines(self.spark, path, self.config, stream)

    def sink(self, write, host=None):
        """A foreachBatch function whose frames reach write only with their value column redacted, after host."""
        return redacting_sink(lambda df: self.redact_lines(df, "value"), write, host)


