"""Expressions as SQL text: parsed in one step where Column calls would cross to the JVM a thousand times.

A body is the text of a lambda of one argument and of nothing else, so that it can be used under any other lambda. Costs of
what works on arrays grow with the array and not with its square.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements up to which running sums are appended one by one; beyond them sums of blocks are added first, of larger blocks in
#: long arrays.
FEW, SMALL_BLOCK, BLOCK = 64, 8, 64


def quote(s: str | None) -> str:
    """A string literal of the engine's SQL."""
    if s is None:
        return "cast(null as string)"
    return "'" + "".join(f"\\u{ord(c):04X}" if c < " " else "\\" + c if c in "\\'" else c for c in s) + "'"


def let(name: str, value: str, body: str) -> str:
    """body with name for a value that is evaluated once, however often body uses it. It is the start of a fold over nothing,
    whose end is the body: a transform of an array of one would make that array and copy all that the body gives."""
    return f"aggregate(array(), {value}, ({name}, none_) -> {name}, {name} -> {body})"


def among(value: str, *of: str) -> str:
    """Whether a value is one of some texts: evaluated inside a lambda, an IN ends by an exception where it finds one."""
    return "(" + " OR ".join(f"{value} = {quote(t)}" for t in of) + ")"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


_WORD = re.compile(r"'(?:[^'\\]|\\.)*'|`[^`]*`|\b(?:CASE|WHEN|THEN|ELSE|END)\b|[^'`A-Z]+|.", re.S)


def _ifs(sql: str) -> str:
    """sql with its searched CASEs as calls of if: evaluated inside a lambda, a CASE walks a list of its branches each time."""
    stack = [[""]]  # of each open CASE what was read of its parts; a CASE of a value has its value in the first part
    kinds = [""]
    for word in _WORD.findall(sql):
        if word == "CASE":
            stack.append([""])
            kinds.append("")
        elif word in ("WHEN", "THEN", "ELSE"):
            stack[-1].append("")
            kinds[-1] += word[0]
        elif word == "END":
            (value, *parts), kind = stack.pop(), kinds.pop()
            if value.strip():
                words = {"W": "WHEN", "T": "THEN", "E": "ELSE"}
                done = "CASE" + value + "".join(words[k] + p for k, p in zip(kind, parts)) + "END"
            else:
                done = parts.pop() if kind.endswith("E") else "null"
                for n in range(len(parts) - 2, -1, -2):
                    done = f"if({parts[n]}, {parts[n + 1]}, {done})"
            stack[-1][-1] += done
        else:
            stack[-1][-1] += word
    return stack[0][0]


def apply(value: Column, body: str) -> Column:
    """The lambda 'x -> body' of a value."""
    return F.call_function("aggregate", F.array(), value, F.expr("(x, none_) -> x"), F.expr(_ifs(body)))


def bind(value: Column, f) -> Column:
    """f, a function of Columns, of a value that is evaluated once."""
    return F.aggregate(F.array(), value, lambda x, _: x, f)


def fence(c: Column) -> Column:
    """c, where the optimiser leaves it: a filter on it stays above. Pushed below, it would hold a copy of all that c is made of
    for each place where a step uses the one before. A bare rand(0) >= 0 won't do: the optimiser knows that it is true."""
    return F.when(F.floor(F.rand(0)) == 0, c)


def total_sql(values: str) -> str:
    return f"aggregate({values}, 0L, (acc_, add_) -> acc_ + add_)"


def running_sql(values: str) -> str:
    """For each element of an array of longs the sum of those before it."""
    def far(most: int) -> str:
        block = f"cast(j_ div {most} as int)"
        sums = f"transform(sequence(0, cast(ceil(size(run_) / {most}) as int) - 1), b_ -> {total_sql(f'slice(run_, b_ * {most} + 1, {most})')})"
        before = f"aggregate({sums}, array(0L), (a_, z_) -> concat(a_, array(get(a_, size(a_) - 1) + z_)))"
        return let("p_", before, f"transform(run_, (y_, j_) -> get(p_, {block}) + {total_sql(f'slice(run_, {block} * {most} + 1, j_ % {most})')})")

    near = "slice(aggregate(run_, array(0L), (a_, y_) -> concat(a_, array(get(a_, size(a_) - 1) + y_))), 1, size(run_))"
    return let("run_", values, f"CASE WHEN size(run_) <= {FEW} THEN {near} WHEN size(run_) <= {SMALL_BLOCK * BLOCK} THEN {far(SMALL_BLOCK)} ELSE {far(BLOCK)} END")


def running(values: Column) -> Column:
    return apply(values, f"x_ -> {running_sql('x_')}")
