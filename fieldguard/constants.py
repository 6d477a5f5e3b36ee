"""Fixed vocabularies of the public interface."""

from __future__ import annotations

# Markers, outcomes, reasons, codes and default limits.
BLOCKED = "[REDACTED:BLOCKED]"
ERROR = "[REDACTED:ERROR]"
LIMIT = "[REDACTED:LIMIT_EXCEEDED]"
CYCLE = "[REDACTED:CYCLE]"
ACTIONS = ("allow", "warn", "redact", "block")
OUTCOMES = ("unchanged", "redacted", "blocked", "limited", "failed")
COUNTS = ("scanned", "findings", "redacted", "blocked", "limited", "failed")
REASONS = ("policy", "limit_exceeded", "unsupported_value", "lifecycle", "core_error")
LIMIT_CODES = ("INPUT_LIMIT_EXCEEDED", "FINDING_LIMIT_EXCEEDED", "BUFFER_LIMIT_EXCEEDED", "TOKEN_LIMIT_EXCEEDED", "MULTILINE_LIMIT_EXCEEDED")
CORE_CODES = (
    "INVALID_INPUT INVALID_OPTIONS INVALID_DETECTOR DETECTOR_FAILURE INVALID_CANDIDATE POLICY_FAILURE INVALID_POLICY_ACTION INVALID_FINDINGS PLACEHOLDER_FAILURE "
    "INVALID_PLACEHOLDER INVALID_LIMITS INPUT_LIMIT_EXCEEDED FINDING_LIMIT_EXCEEDED BUFFER_LIMIT_EXCEEDED TOKEN_LIMIT_EXCEEDED MULTILINE_LIMIT_EXCEEDED "
    "INVALID_STATE INVALID_RULESET NOT_INITIALIZED INITIALIZATION_FAILED INVALID_CHUNK INVALID_UTF8 UNPAIRED_SURROGATE"
).split()
BOUNDARIES = ("user-input", "tool-result", "tool-arguments", "resource", "context")
CONTENT_TYPES = ("text", "image", "audio", "resource_link", "resource")
ERROR_LINE = '{"msg":"[REDACTED:ERROR]"}'
LIMIT_LINE = '{"msg":"[REDACTED:LIMIT_EXCEEDED]"}'
RESOURCE_ERROR_CODE = -32603
BLOCKED_TEXT = "This MCP tool call was blocked by secret-redaction policy. No content, arguments, or error detail is included."
TOOL_ERROR_TEXT = "This MCP tool call failed. No content, arguments, or error detail is included."
RESOURCE_BLOCKED_TEXT = "This MCP resource read was blocked by secret-redaction policy. No content, URI, or error detail is included."
RESOURCE_ERROR_TEXT = "This MCP resource read failed. No content, URI, or error detail is included."

WALK_LIMITS = {"max_depth": 8, "max_array_length": 1000, "max_object_keys": 200, "max_string_length": 200_000, "max_total_leaves": 5000, "max_nodes": 20_000}
OPERATION_LIMITS = {"max_bytes": 16 << 20, "max_nodes": 100_000, "max_keys": 100_000, "max_leaves": 25_000, "max_scans": 50_000, "max_findings": 100_000}
CONTEXT_LIMITS = {"max_input_bytes": 65_536, "max_findings": 256, "max_depth": 16, "max_nodes": 4096}
INCREMENTAL_LIMITS = {"max_input_bytes": 1_048_576, "max_buffered_bytes": 65_536, "max_token_bytes": 8192, "max_multiline_bytes": 32_768}
LINE_LIMITS = {"max_line": 4_194_304, "max_spans": 20_000, "max_decode": 2_097_152}

FINDING = "struct<id:string,type:string,detector:string,confidence:string,action:string,obfuscation:string,start:int,end:int>"


def resolve_limit(value: object, default: int) -> int:
    """A usable limit is a number of at least 0 and no boolean; anything else falls back."""
    if isinstance(value, bool) or not isinstance(value, (int, float)) or value != value or value < 0:
        return default
    return int(min(value, 2**53))


def resolve_limits(given: dict | None, defaults: dict[str, int]) -> dict[str, int]:
    """Each key on its own falls back to its default; unknown keys are ignored."""
    return {k: resolve_limit((given or {}).get(k), d) for k, d in defaults.items()}
