"""Deterministic workloads: log events, spans and chat payloads made by expression, for benches and tests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The words of texts.
WORDS = ("request handled for the tenant after cache lookup with retry budget left in queue while worker keeps state").split()


@dataclass(frozen=True)
class Profile:
    """shape: log, span or payload. token_every: one unit in so many holds a token."""

    shape: str
    args: int = 2
    fields: int = 8
    words: int = 6
    token_every: int = 8
    depth: int = 0
    array: int = 0
    attributes: int = 16
    events: int = 2
    messages: int = 8
    tools: int = 2
    long: int = 0


PROFILES = {
    "log-flat": Profile("log"),
    "log-nested": Profile("log", depth=4, array=16),
    "span-attributes": Profile("span", attributes=16, array=8, events=2, words=12),
    "mask-payload": Profile("payload", messages=8, tools=2, words=40),
    "log-scale-4x": Profile("log", fields=32),
    "log-scale-16x": Profile("log", fields=128),
    "limit-depth": Profile("log", depth=16),
    "limit-keys": Profile("log", fields=250),
    "limit-array": Profile("log", array=1500),
    "limit-string-over": Profile("log", long=220_000),
}


def words(seed: Column, n: int) -> Column:
    """n words picked by a hash of the seed."""
    pool = F.array(*[F.lit(w) for w in WORDS])
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(max(1, n))), lambda i: F.get(pool, F.pmod(F.xxhash64(seed, i), F.lit(len(WORDS))).cast("int"))), " ")


def token(seed: Column) -> Column:
    """A synthetic token: the prefix, a hash of 32 hexadecimal digits, and 0000."""
    return F.concat(F.lit("gh"), F.lit("p_"), F.md5(seed.cast("string")), F.lit("0000"))


def _nested(seed: Column, depth: int, n: int) -> Column:
    out = words(seed, n)
    for _ in range(depth):
        out = F.struct(out.alias("v"))
    return out


def build(source: SparkSession | DataFrame, profile: str | Profile, n: int | None = None) -> DataFrame:
    """n units of a profile, or one for each row of a frame with a column id; the same rows in every run."""
    p = PROFILES[profile] if isinstance(profile, str) else profile
    i = F.col("id")
    secret = F.when(i % p.token_every == 0, F.concat(F.lit("key "), token(i))).otherwise("no key")
    base = source.select("id") if isinstance(source, DataFrame) else source.range(n)
    if p.shape == "span":
        attributes = F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(p.attributes)), lambda k: F.struct(F.concat(F.lit("attr."), k.cast("string")), F.when(k == 1, secret).otherwise(words(F.xxhash64(i, k), p.words)))))
        arrays = F.create_map(*[x for k in ("a", "b") for x in (F.lit(k), F.transform(F.sequence(F.lit(1), F.lit(max(1, p.array))), lambda j: words(F.xxhash64(i, j), 2)))])
        event = lambda e: F.struct(F.concat(F.lit("event "), e.cast("string")).alias("name"), F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: F.struct(F.concat(F.lit("e."), k.cast("string")), words(F.xxhash64(i, e, k), 3)))).alias("attributes"))
        return base.select(i.alias("span_id"), words(i, 3).alias("name"), attributes.alias("attributes"), arrays.alias("array_attributes"), F.struct(F.lit(0).alias("code"), words(i, 4).alias("message")).alias("status"), F.transform(F.sequence(F.lit(1), F.lit(p.events)), event).alias("events"))
    if p.shape == "payload":
        message = lambda m: F.struct(F.when(m % 2 == 1, "user").otherwise("assistant").alias("role"), F.when(m == 1, F.concat(words(F.xxhash64(i, m), p.words), F.lit(" "), secret)).otherwise(words(F.xxhash64(i, m), p.words)).alias("content"))
        tool = lambda t: F.struct(F.concat(F.lit("tool"), t.cast("string")).alias("name"), F.struct(words(F.xxhash64(i, t), 4).alias("query"), t.alias("limit")).alias("arguments"))
        return base.select(i.alias("payload_id"), F.transform(F.sequence(F.lit(1), F.lit(p.messages)), message).alias("messages"), F.transform(F.sequence(F.lit(1), F.lit(p.tools)), tool).alias("tool_calls"))
    fields = [words(F.xxhash64(i, F.lit(k)), p.words).alias(f"field{k}") for k in range(p.fields)]
    if p.depth:
        fields.append(_nested(i, p.depth, p.words).alias("nested"))
    if p.array:
        fields.append(F.transform(F.sequence(F.lit(1), F.lit(p.array)), lambda j: words(F.xxhash64(i, j), 2)).alias("items"))
    if p.long:
        fields.append(F.repeat(F.lit("long text "), p.long // 10).alias("long"))
    return base.select(i.alias("record_id"), F.lit(30).alias("level"), F.struct(*fields).alias("obj"), F.lit("handled %s in %s").alias("fmt"), F.array(secret, *[words(F.xxhash64(i, F.lit(-k)), 2) for k in range(1, p.args)]).alias("args"), F.lit("").alias("msg_prefix"))


def digest(df: DataFrame, *names: str) -> Column:
    """SHA-256 of a unit's canonical JSON: the columns in order."""
    return F.sha2(F.to_json(F.struct(*(names or df.columns))), 256)


def context_parts(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Log events as the parts of contexts: (key, turn, role, text), a user's text and a tool's value as JSON."""
    parts = F.array(
        F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role"), F.concat_ws(" ", "fmt", F.array_join("args", " ")).alias("text")),
        F.struct(F.lit(1).alias("turn"), F.lit("tool").alias("role"), F.to_json("obj").alias("text")),
    )
    return df.select(key, F.explode(parts).alias("p")).select(key, "p.*")


def tool_results(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Log events as tool results: (key, result), JSON of one text block for each argument."""
    block = F.transform("args", lambda a: F.struct(F.lit("text").alias("type"), a.alias("text")))
    return df.select(key, F.to_json(F.struct(block.alias("content"))).alias("result"))


def stream_chunks(df: DataFrame, text: Column, key: str = "record_id", size: int = 16) -> DataFrame:
    """A text of each unit cut into chunks: (stream_id, seq, op, chunk), appends and one finalize. A text is gone through once:
    each substr would count its characters from the start again."""
    parts = F.when(F.length(text) > size, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))).otherwise(F.array(text))
    appends = F.transform(parts, lambda c, i: F.struct(i.cast("long").alias("seq"), F.lit("append").alias("op"), c.alias("chunk")))
    end = F.struct(F.size(parts).cast("long").alias("seq"), F.lit("finalize").alias("op"), F.lit(None).cast("string").alias("chunk"))
    return df.select(F.col(key).alias("stream_id"), F.explode(F.concat(appends, F.array(end))).alias("s")).select("stream_id", "s.*")


def brief(outcome: Column) -> Column:
    """An outcome without values, for comparing runs: what it is, why, and how many findings of which actions."""
    count = lambda a: F.size(F.filter(outcome["findings"], lambda f: f["action"] == a))
    return F.concat_ws("|", outcome["outcome"], F.coalesce(outcome["reason"], F.lit("-")), F.coalesce(outcome["code"], F.lit("-")), *[count(a).cast("string") for a in ("allow", "warn", "redact", "block")])


def parity(df: DataFrame, outcome: str) -> DataFrame:
    """(units, hash): one hash over the briefs of all rows, whatever their order."""
    return df.select(F.xxhash64(brief(F.col(outcome))).alias("h")).agg(F.count("*").alias("units"), F.sum(F.pmod("h", F.lit(1_000_003))).alias("hash"))
