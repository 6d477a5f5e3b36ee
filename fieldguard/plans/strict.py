"""Strict boundaries over JSON texts: values, tool results, arguments and resources as single operations.

What crosses is an outcome; errors, inputs and messages of errors never do. A tool's result is one strict walk over all of it;
binaries that may pass are no events, so they stay where they are; then the backstop scans each part of the clean result as
text, for what a sibling's or a parent's key gives away.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BOUNDARIES, CONTENT_TYPES
from ..functions.arrays import among, apply, fence, let, quote, running_sql, struct
from ..functions.leaf import has_sql
from ..functions.scanner import scan_sql, sign_sql, with_callables
from ..operators.strict import EVENT, OUTCOME, STEPS, Strict, json_events, json_tokens, json_value, judge

OPERATIONS = ("text", "value", "dispatch", "tool_result", "tool_arguments", "resource_result")
#: The list of parts that a result has, by operation, and the fields of a part that hold binary.
LISTS = {"tool_result": "content", "resource_result": "contents"}


def _last(of: str) -> str:
    return let("lst_", of, "get(lst_, size(lst_) - 1)")


def _end(value: str) -> str:
    """The place of the last token of the value at a place, of tokens x.u (depths) and x.close."""
    return f"CASE WHEN get(x.e, {value}).kind = 'open' THEN get(filter(x.close, c_ -> c_.at > {value} AND c_.u = get(x.u, {value}) + 1), 0).at ELSE {value} END"


def _field(name: str, depth: str, a: str, z: str) -> str:
    """The last field of a name, struct<at, v, z> (its key, its value, its end), at a depth between two places."""
    return let("fld_", _last(f"filter(x.keys, k_ -> k_.u = {depth} AND k_.at > {a} AND k_.at < {z} AND k_.t = {quote(name)})"), f"CASE WHEN fld_ IS NOT NULL THEN {struct(at='fld_.at', v='fld_.at + 2', z=_end('(fld_.at + 2)'))} END")


def _is_text(field: str) -> str:
    return f"get(x.e, {field}.v).kind = 'leaf'"


def _with_parts(df: DataFrame, operation: str, binary: str) -> DataFrame:
    """df with fg_parts, the parts of a result struct<a, z, bin, hide, ok>: their places, the field of binary, the field that
    the backstop leaves out, and whether the part is one that may pass; and fg_shape, why a result is no result."""
    name, out = LISTS[operation], df

    def step(column: str, body: str, *of: str) -> None:
        nonlocal out
        out = out.withColumn(f"fg_{column}", apply(F.struct(*[F.col(f"fg_{k}").alias(k) for k in of]), f"x -> {body}"))

    step("u", running_sql("transform(x.e, e_ -> CASE WHEN e_.kind = 'open' THEN 1L WHEN e_.kind = 'close' THEN -1L ELSE 0L END)"), "e")
    step("keys", f"filter(transform(x.e, (e_, i_) -> CASE WHEN e_.kind = 'key' AND get(x.u, i_) <= 4 THEN {struct(at='i_', u='get(x.u, i_)', t='e_.t')} END), k_ -> k_ IS NOT NULL)", "e", "u")
    step("close", f"filter(transform(x.e, (e_, i_) -> CASE WHEN e_.kind = 'close' AND get(x.u, i_) <= 5 THEN {struct(at='i_', u='get(x.u, i_)')} END), c_ -> c_ IS NOT NULL)", "e", "u")
    step("list", _field(name, "1", "0", "size(x.e)"), "e", "u", "keys", "close")
    inside = f"i_ > x.list.v AND i_ < x.list.z AND get(x.u, i_) = 2 AND {among('e_.kind', 'open', 'node', 'leaf')}"
    step("starts", f"filter(transform(x.e, (e_, i_) -> CASE WHEN {inside} THEN i_ END), p_ -> p_ IS NOT NULL)", "e", "u", "list")
    is_object = "get(x.tokens, p_) <=> '{'"
    none = "cast(null as struct<at:int,v:int,z:int>)"
    if operation == "tool_result":
        kind, blob = f"CASE WHEN {_is_text('ty_')} THEN get(x.e, ty_.v).t END", _field("blob", "4", "re_.v", "re_.z")
        data, text, inner_text = _field("data", "3", "p_", "z_"), _field("text", "3", "p_", "z_"), _field("text", "4", "re_.v", "re_.z")
        fields = struct(a="p_", z="z_", bin=f"CASE WHEN {among('kn_', 'image', 'audio')} THEN {data} WHEN kn_ = 'resource' THEN {blob} ELSE {none} END", hide=f"CASE WHEN kn_ = 'text' THEN {text} WHEN kn_ = 'resource' THEN {inner_text} ELSE {none} END", ok=f"coalesce({is_object} AND {among('kn_', *CONTENT_TYPES)} AND (kn_ <> 'resource' OR get(x.tokens, re_.v) <=> '{{'), false)")
        part = let("ty_", _field("type", "3", "p_", "z_"), let("kn_", kind, let("re_", _field("resource", "3", "p_", "z_"), fields)))
        shape = f"CASE WHEN NOT get(x.tokens, 0) <=> '{{' OR x.list IS NOT NULL AND NOT get(x.tokens, x.list.v) <=> '[' THEN false ELSE true END"
    else:
        fields = struct(a="p_", z="z_", bin="bl_", hide="te_", ok=f"coalesce({is_object} AND (te_ IS NULL) <> (bl_ IS NULL) AND (te_ IS NULL OR {_is_text('te_')}), false)")
        part = let("te_", _field("text", "3", "p_", "z_"), let("bl_", _field("blob", "3", "p_", "z_"), fields))
        shape = "get(x.tokens, 0) <=> '{' AND x.list IS NOT NULL AND get(x.tokens, x.list.v) <=> '['"
    step("parts", f"CASE WHEN get(x.tokens, x.list.v) <=> '[' THEN transform(x.starts, p_ -> {let('z_', _end('p_'), part)}) END", "tokens", "e", "u", "keys", "close", "list", "starts")
    passes = f"p_.ok AND (p_.bin IS NULL OR {_is_text('p_.bin')})" if binary == "pass" else "p_.ok AND p_.bin IS NULL"
    step("shape", f"CASE WHEN x.tokens IS NULL OR NOT ({shape}) OR exists(x.parts, p_ -> NOT coalesce({passes}, false)) THEN 'unsupported_value' END", "tokens", "e", "list", "parts")
    # what passes as it is is no event
    gone = f"exists(x.parts, p_ -> p_.bin IS NOT NULL AND (i_ = p_.bin.at OR i_ = p_.bin.v))"
    silent = struct(kind="'none'", k="cast(null as string)", t="cast(null as string)", up="1L", bad="cast(null as string)")
    step("e", f"CASE WHEN x.shape IS NOT NULL OR x.tokens IS NULL THEN cast(array() as array<{EVENT}>) WHEN exists(x.parts, p_ -> p_.bin IS NOT NULL) THEN cast(transform(x.e, (e_, i_) -> CASE WHEN {gone} THEN {silent} ELSE e_ END) as array<{EVENT}>) ELSE x.e END", "tokens", "e", "parts", "shape")
    return out


def _without(tokens: str, a: str, z: str, *fields: str) -> str:
    """The text of tokens from a to z without some fields, and without a comma that would be left over."""
    def drops(f: str) -> str:
        before, after = f"get({tokens}, {f}.at - 1) <=> ','", f"get({tokens}, {f}.z + 1) <=> ','"
        return f"({f} IS NOT NULL AND (j_ + {a} BETWEEN {f}.at AND {f}.z OR {before} AND j_ + {a} = {f}.at - 1 OR NOT {before} AND {after} AND j_ + {a} = {f}.z + 1))"

    cut = " OR ".join(f"coalesce({drops(f)}, false)" for f in fields) or "false"
    return f"array_join(filter(slice({tokens}, {a} + 1, {z} - {a} + 1), (q_, j_) -> NOT ({cut})), '')"


def _backstop(rules: Strict, names: tuple[str, ...], part: str) -> str:
    """struct<reason, code> of a part's text: a finding in it that redacts or blocks refuses the whole; null where it passes."""
    most, none = rules.most(), "cast(null as string)"
    refusal = lambda reason, code=None: struct(reason=quote(reason), code=quote(code))
    judged = f"CASE WHEN bs_.code IS NOT NULL THEN {struct(reason=quote('core_error'), code='bs_.code')} WHEN size(bs_.findings) > {most['max_findings']} THEN {refusal('limit_exceeded', 'FINDING_LIMIT_EXCEEDED')} WHEN {has_sql('bs_.findings', 'redact', 'block')} THEN {struct(reason=quote('policy'), code=none)} END"
    return let("pt_", part, f"CASE WHEN octet_length(pt_) > {most['max_input_bytes']} THEN {refusal('limit_exceeded', 'INPUT_LIMIT_EXCEEDED')} WHEN {sign_sql('pt_', rules.config)} THEN {let('bs_', scan_sql('pt_', rules.config, None, 'x', names), judged)} END")


def sanitize(df: DataFrame, operation: str, value: Column, rules: Strict = Strict(), label: str = "user-input", aborted: Column | None = None, failed: Column | None = None, into: str = "o") -> DataFrame:
    """df with a column struct<outcome, value, findings, emitted, reason, code> of JSON texts under one of OPERATIONS.

    value is compact JSON text again; findings has the findings of ok outcomes, emitted all that an observer sees, also of
    blocked values. Text that isn't JSON, and a null, is unsupported, but a null for tool_arguments is a call without
    arguments. aborted and failed are conditions of rows: cancelled before the start, or the producer has failed.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"operation must be one of {', '.join(OPERATIONS)}")
    if label not in BOUNDARIES:
        raise ValueError(f"label must be one of {', '.join(BOUNDARIES)}")
    tools = operation in LISTS
    out = df.withColumns({"fg_stop": F.coalesce(aborted, F.lit(False)) if aborted is not None else F.lit(False), "fg_failed": F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)})
    out = out.withColumn("fg_tokens", F.when(~F.col("fg_stop") & ~F.col("fg_failed"), json_tokens(value)))
    out = out.withColumn("fg_e", json_events(F.col("fg_tokens")))
    if tools:
        out = _with_parts(out, operation, rules.binary)
    else:
        shape = {"text": "NOT (size(fg_e) = 1 AND get(fg_e, 0).kind = 'leaf')", "tool_arguments": "NOT get(fg_tokens, 0) <=> '{'"}.get(operation, "false")
        out = out.withColumn("fg_shape", F.expr(f"CASE WHEN fg_tokens IS NULL OR {shape} THEN 'unsupported_value' END"))
        out = out.withColumn("fg_e", F.expr(f"CASE WHEN fg_shape IS NULL THEN fg_e ELSE cast(array() as array<{EVENT}>) END"))
    scope = {"text": "'text'", "dispatch": "CASE WHEN size(x.e) = 1 AND get(x.e, 0).kind = 'leaf' THEN 'text' END"}.get(operation)
    out = judge(out.drop("fg_keys", "fg_u"), rules, label, scope=scope, memo=operation != "text") if not tools else judge(out.drop("fg_keys"), rules, label)
    out = out.withColumn("fg_clean", F.when(F.col("fg_shape").isNull() & F.col("fg_bad").isNull(), apply(F.struct(*[F.col(f"fg_{k}").alias(k) for k in ("tokens", "e", "d")]), f"x -> {json_value_tokens()}")))
    bad = F.col("fg_bad")
    if tools or operation == "tool_arguments":
        value_, names = with_callables(rules.config, clean=F.col("fg_clean"), **({"parts": F.col("fg_parts"), "list": F.col("fg_list")} if tools else {}))
        if tools:
            whole = f"array({_without('x.clean', '0', '(size(x.clean) - 1)', 'x.list')})"
            texts = f"concat({whole}, coalesce(transform(x.parts, p_ -> {_without('x.clean', 'p_.a', 'p_.z', 'p_.bin', 'p_.hide')}), cast(array() as array<string>)))"
        else:
            texts = "array(array_join(x.clean, ''))"
        out = out.withColumn("fg_texts", apply(value_, f"x -> CASE WHEN x.clean IS NOT NULL THEN {texts} END"))
        value_, names = with_callables(rules.config, texts=F.col("fg_texts"))
        out = out.withColumn("fg_caught", apply(value_, f"x -> get(filter(transform(x.texts, tx_ -> {_backstop(rules, names, 'tx_')}), p_ -> p_ IS NOT NULL), 0)"))
        bad = F.coalesce(bad, F.col("fg_caught"))
    error = "read_error" if operation == "resource_result" else "tool_error"
    out = out.withColumn("fg_bad", F.when(F.col("fg_shape").isNotNull(), F.struct(F.col("fg_shape").alias("reason"), F.lit(None).cast("string").alias("code"))).otherwise(bad))
    stopped = "fg_stop OR fg_failed"
    missing = F.when(~F.col("fg_stop") & ~F.col("fg_failed"), value.isNull()) if operation == "tool_arguments" else F.lit(False)
    out = out.withColumn("fg_missing", F.coalesce(missing, F.lit(False)))
    none = f"cast(array() as {OUTCOME.split('findings:')[1].split(',emitted')[0]})"
    found = (
        f"named_struct('outcome', CASE WHEN fg_stop THEN 'aborted' WHEN fg_failed THEN '{error}' WHEN fg_missing OR fg_bad IS NULL THEN 'ok' ELSE 'blocked' END, 'value', CASE WHEN NOT ({stopped}) AND fg_bad IS NULL THEN array_join(fg_clean, '') END, "
        f"'findings', CASE WHEN {stopped} THEN NULL WHEN fg_missing THEN {none} WHEN fg_bad IS NULL THEN fg_kept END, 'emitted', CASE WHEN {stopped} OR fg_missing THEN {none} ELSE fg_seen END, "
        f"'reason', CASE WHEN NOT ({stopped} OR fg_missing) THEN fg_bad.reason END, 'code', CASE WHEN NOT ({stopped} OR fg_missing) THEN fg_bad.code END)"
    )
    extra = ("fg_stop", "fg_failed", "fg_tokens", "fg_shape", "fg_u", "fg_close", "fg_list", "fg_starts", "fg_parts", "fg_clean", "fg_texts", "fg_caught", "fg_missing")
    return out.withColumn(into, fence(F.expr(found))).drop(*STEPS, *extra)


def json_value_tokens() -> str:
    """The tokens of a clean value, changed where a text was."""
    return json_value().removeprefix("array_join(").removesuffix(", '')")


def call_tools(df: DataFrame, invoke: Callable[[DataFrame], DataFrame], arguments: str = "arguments", result: str = "result", rules: Strict = Strict(), aborted: Column | None = None, into: str = "o") -> DataFrame:
    """Calls, a row each: clean arguments (JSON, null for none) to invoke, a function of the frame of calls whose arguments are
    fine that adds a column of results, and its results clean again. A null result is a tool that failed; a blocked call
    never reaches the tool. into names the outcome struct of the call, fg_stage the stage that decided it."""
    judged = sanitize(df, "tool_arguments", F.col(arguments), rules, "tool-arguments", aborted, into=into)
    fine = judged.where(F.col(into)["outcome"] == "ok").withColumn(arguments, F.col(into)["value"]).drop(into)
    answered = invoke(fine)
    done = sanitize(answered, "tool_result", F.col(result), rules, "tool-result", failed=F.col(result).isNull(), into=into).drop(result).withColumn("fg_stage", F.lit("result"))
    refused = judged.where(F.col(into)["outcome"] != "ok").withColumn(arguments, F.lit(None).cast("string")).withColumn("fg_stage", F.lit("arguments"))
    return refused.unionByName(done, allowMissingColumns=True)
