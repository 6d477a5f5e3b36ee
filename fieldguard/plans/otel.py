"""The former name of the span transforms."""

from .hosts import redact_attributes, redact_spans, span_leaves

__all__ = ["redact_attributes", "redact_spans", "span_leaves"]
