"""JSON text in expressions: whether a text is one strict value, its tokens, and literals read and written.

The engine's own parser decides what is JSON, with its leniences switched off; tokens are cut by one pattern.
"""

from __future__ import annotations

from .arrays import let, quote

#: A string literal. The loops never give back, so that Java needn't recurse for each turn.
STRING = r'"[^"\\]*+(?:\\(?s:.)[^"\\]*+)*+"'
#: A string literal and, where it is a key, its colon.
LITERAL = STRING + r"(?:\s*+:)?+"
#: Any token of a strict value.
TOKEN = STRING + r"|[{}\[\],:]|[^\s{}\[\],:\"]++"
#: Stand for an escaped backslash and an escaped quote: no strict value holds these signs themselves.
_BACKSLASH, _QUOTE = "\u0005", "\u0006"
_STRICT = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false', 'mode', 'PERMISSIVE')"


def is_json(text: str) -> str:
    """Whether a text is exactly one JSON value. As the only element of an array and as the only value of an object it can't
    close either early, and nothing follows it. Names may repeat. What the parser itself refuses is none: nesting beyond
    1000 levels and numbers of over 1000 digits. A text without the end of an array needs no second look: it can't close one."""
    alone = f"size(from_json(concat('[', {text}, ']'), 'array<string>', {_STRICT}))"
    return f"coalesce({alone} = 1 AND (NOT contains({text}, ']') OR size(from_json(concat('{{\"v\":', {text}, '}}'), 'map<string,string>', {_STRICT})) = 1), false)"


def turns_of(text: str, sign: str, strict: bool = False) -> str:
    """Gaps and literals by turns: a text cut at its literals, with sign on both sides of each, which it doesn't hold itself. In
    a strict value escaped backslashes and quotes are put aside first: a literal then ends with the next quote, and no escape
    is a turn of the search."""
    cut = lambda of, pattern: f"regexp_replace({of}, {quote(pattern)}, concat({quote(sign)}, '$0', {quote(sign)}))"
    if strict:
        given = text
        aside = ((_BACKSLASH, "\\\\"), (_QUOTE, '\\"'))
        for mark, escaped in aside:
            text = f"replace({text}, {quote(escaped)}, {quote(mark)})"
        plain = r'"[^"]*+"(?:\s*+:)?+'
        cuts = cut(text, plain)
        for mark, escaped in aside:
            cuts = f"replace({cuts}, {quote(mark)}, {quote(escaped)})"
        cuts = f"CASE WHEN contains({given}, {quote(aside[1][1])}) THEN {cuts} ELSE {cut(given, plain)} END"
    else:
        cuts = cut(text, LITERAL)
    return f"split({cuts}, {quote(sign)}, -1)"


def text_of(literal: str) -> str:
    """The text of a string literal."""
    return f"CASE WHEN contains({literal}, '\\\\') THEN get(from_json(concat('[', {literal}, ']'), 'array<string>'), 0) ELSE substr({literal}, 2, length({literal}) - 2) END"


def literal_of(text: str) -> str:
    """The string literal of a text."""
    # by bytes: characters would be gone through from the start
    return let("lit_", f"to_json(array({text}))", "cast(substr(cast(lit_ as binary), 2, octet_length(lit_) - 2) as string)")


def lone_surrogate(literal: str) -> str:
    """Whether a literal has an escaped half of a pair alone, which no text holds."""
    pairs = quote(r"\\\\|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}")
    return f"(contains({literal}, '\\\\u') AND regexp_replace({literal}, {pairs}, '') rlike {quote(r'\\u[dD][89a-fA-F]')})"
