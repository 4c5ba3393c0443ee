"""Secret scans by multipart credential linking, in DataFrame functions only.

Base kinds are found by pattern: assign, access and hex. Further parts are weak on their own: names of accounts
(identity), bare random strings (key) and addresses of services (endpoint). Each part has a role: identifier, secret or endpoint.
Parts are intervals of code points; within a document, an interval join over scopes (`scope` code points around a part) finds
for every part the nearest part of each other role on either side, by running maxima in order of position and against it, so no
pairs are made. A weak secret is reported only beside an identifier or endpoint, a weak identifier and an endpoint only beside
a secret. Base spans are always reported. A link names a reported secret, the identifier and the endpoint nearest to it in its scope.

A key may follow '=' directly, as in NAME=value, has 24 characters or more, and holds a digit and a capital. A random string that is the
value of an identity is no key: it would stand beside itself.

All work is in proportion to text and matches: places are running sums over the matches of a kind, and redaction cuts pieces out of
a fixed-width encoding.

Defined cases: null text is empty; documents without parts have empty digests; repeated rows give repeated rows; an empty
table gives an empty table. Kinds are ordered as in KINDS; weak parts that overlap a base span are dropped. Further columns may have any
names: secrets() ignores them, redacted() keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leafmill.llm.common import by_content, content_key, materialise

SCOPE = 200
#: kind: (pattern, smallest length, group that the length is of, role, part of the base); the first three patterns are fixed values.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, "secret", True),
    "access": (r"AKIA[A-Z0-9]{16,}", 20, 0, "identifier", True),
    "hex": (r"[0-9a-f]{24,}", 24, 0, "secret", True),
    "identity": (r"""(?i)(?:user(?:_?name)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]+""", 6, 0, "identifier", False),
    "key": (r"[A-Za-z0-9+/]{24,}={0,2}", 24, 0, "secret", False),
    "endpoint": (r"""(?:https?|jdbc:[a-z]+|ftp|redis|amqp|mongodb)://[^\x00-\x20"'<>]+""", 8, 0, "endpoint", False),
}
#: What a match must hold besides.
HOLDS = {"key": ("[0-9]", "[A-Z]")}
MATCHES = "array<struct<k:int,i:int,gap:int,n:int,ok:boolean>>"


def matches_of(text: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches of one kind in order: number, characters since the last one, length, and whether it counts."""
    pattern, least, group, _, _ = KINDS[kind]
    k = list(KINDS).index(kind)
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"), F.split(text, pattern, -1).alias("before"))

    def told(x: Column, i: Column) -> Column:
        ok = F.length(x["g"]) >= least
        for held in HOLDS.get(kind, ()):
            ok &= x["m"].rlike(held)
        return F.struct(F.lit(k).alias("k"), i.alias("i"), F.length(x["before"]).alias("gap"), F.length(x["m"]).alias("n"), ok.alias("ok"))

    every = F.filter(F.transform(found, told), lambda x: x["n"].isNotNull())  # what follows the last match is no match
    return F.when(text.rlike(pattern), every.cast(MATCHES)).otherwise(F.array().cast(MATCHES))


def placed(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """keep, row__ (a number of the row) and its parts: start, end, k, role, base; one row with nulls for a document without any."""
    names = list(KINDS)
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("row__"), F.coalesce("text", F.lit("")).alias("text__"))
    kept = [F.col(c) for c in rows.columns[:-1]]
    found = rows.select(*kept, F.explode_outer(F.concat(*[matches_of(F.col("text__"), k) for k in names])).alias("m")).select(*kept, "m.*").repartition("row__")
    earlier = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy("row__", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    start = (F.coalesce(earlier, F.lit(0)) + F.col("gap")).cast("int")
    role, base = (F.element_at(F.array(*[F.lit(KINDS[k][i]) for k in names]), F.col("k") + 1) for i in (3, 4))
    counts = F.coalesce("ok", F.lit(False))
    parts = found.withColumn("start", start)
    return parts.select(*kept, "start", (F.col("start") + F.col("n")).alias("end"), "k", F.when(counts, role).alias("role"), (counts & F.coalesce(base, F.lit(False))).alias("base"))


def linked(docs: DataFrame, keep: list[Column], scope: int = SCOPE) -> DataFrame:
    """For each row of docs keep, spans (the sorted reported spans: start, k, end, and cover, the end of what earlier ones cover) and links (secret, identifier, endpoint: starts)."""
    names = list(KINDS)
    parts = placed(docs, keep)
    kept = parts.columns[: len(keep)]
    place = ("start", "k", "end")
    order = Window.partitionBy("row__").orderBy(*place)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row__").orderBy(*[F.desc(c) for c in place]).rowsBetween(Window.unboundedPreceding, -1)
    identity, key = (F.lit(names.index(k)) for k in ("identity", "key"))
    none = F.lit(False)
    value = (F.col("k") == key) & F.coalesce(F.max(F.when((F.col("k") == identity) & F.col("role").isNotNull(), F.col("end"))).over(before) > F.col("start"), none)
    parts = parts.withColumn("value", F.coalesce(value, none)).withColumn("role", F.when(~F.col("value"), F.col("role")))
    roles = ("identifier", "secret", "endpoint")
    last = {r: F.max(F.when(F.col("role") == r, F.struct("end", "start"))).over(before) for r in roles}
    following = {r: F.min(F.when(F.col("role") == r, F.struct("start", "end"))).over(after) for r in roles}
    parts = parts.withColumns({**{f"last_{r}": x for r, x in last.items()}, "base_end": F.max(F.when(F.col("base"), F.col("end"))).over(before)})
    parts = parts.withColumns({**{f"next_{r}": x for r, x in following.items()}, "base_start": F.min(F.when(F.col("base"), F.col("start"))).over(after)})

    def nearest(other: str) -> Column:
        """Start of the nearest part of that role within the scope."""
        back, ahead = F.col("start") - F.col(f"last_{other}.end"), F.col(f"next_{other}.start") - F.col("end")
        far = F.lit(1 << 30)
        near = F.when(F.coalesce(back, far) <= F.coalesce(ahead, far), F.struct(back.alias("d"), F.col(f"last_{other}.start").alias("at"))).otherwise(F.struct(ahead.alias("d"), F.col(f"next_{other}.start").alias("at")))
        return F.when(near["d"] <= scope, near["at"])

    parts = parts.withColumns({f"near_{r}": nearest(r) for r in roles})
    beside = lambda r: F.col(f"near_{r}").isNotNull()
    covered = F.coalesce(F.col("base_end") > F.col("start"), none) | F.coalesce(F.col("base_start") < F.col("end"), none)
    complement = F.when(F.col("role") == "secret", beside("identifier") | beside("endpoint")).when(F.col("role").isNotNull(), beside("secret")).otherwise(none)
    parts = parts.withColumn("reported", F.col("base") | (complement & ~covered & ~F.col("value")))
    cover = F.coalesce(F.max(F.when(F.col("reported"), F.col("end"))).over(before), F.lit(0))
    span = F.when(F.col("reported"), F.struct("start", "k", "end", F.col("cover")))
    link = F.when(F.col("reported") & (F.col("role") == "secret") & (beside("identifier") | beside("endpoint")), F.struct(F.col("start").alias("secret"), F.col("near_identifier").alias("identifier"), F.col("near_endpoint").alias("endpoint")))
    told = parts.withColumn("cover", cover).withColumns({"span": span, "link": link})
    return told.groupBy("row__").agg(*[F.first(c).alias(c) for c in kept], F.array_sort(F.collect_list("span")).alias("spans"), F.array_sort(F.collect_list("link")).alias("links")).drop("row__")


def named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["k"] + 1), s["start"], s["end"])), ",")


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, links (secret:identifier:endpoint, starts, '-' for none) for each row of docs."""
    found = linked(docs, [F.col("doc_id")], scope)
    count = lambda i: F.size(F.filter("spans", lambda s: s["k"] == i)).cast("long")
    base = F.filter("spans", lambda s: s["k"] < 3)
    shown = lambda x: F.coalesce(x.cast("string"), F.lit("-"))
    links = F.array_join(F.transform("links", lambda x: F.concat_ws(":", x["secret"], shown(x["identifier"]), shown(x["endpoint"]))), ",")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"), links.alias("links"))


def redacted(docs: DataFrame, scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """docs with each run of overlapping reported spans replaced by mark; n_chars, where there is one, follows the text. All other columns stay as they are."""
    found = linked(docs, content_key(), scope).where(F.size("spans") > 0)
    found = materialise(found.dropDuplicates(["id_", "hash_", "size_"]).drop("links"), "spans")
    both, (spans,) = by_content(docs, found, "left", F.lit(64) + 16 * F.size("spans"))
    text = F.col("text")

    def cleaned(wide: Column) -> Column:
        cut = lambda a, b: F.decode(F.substring(wide, 4 * a + 1, 4 * (b - a)), "UTF-32")
        pieces = F.transform(F.filter(spans, lambda s: s["start"] >= s["cover"]), lambda s: cut(s["cover"], s["start"]))
        rest = cut(F.array_max(F.transform(spans, lambda s: s["end"])), F.length(wide) / 4)
        return F.array_join(F.concat(pieces, F.array(rest)), mark)

    # four bytes for each code point; an argument of a function, so that it is made once for a text and not for each piece
    once = F.element_at(F.transform(F.array(F.encode("text", "UTF-32")), cleaned), 1)
    new = F.when(spans.isNotNull() & text.isNotNull(), once).otherwise(text)
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(spans.isNotNull(), F.length(new).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return both.select(*[(new if c == "text" else x).alias(c) for c, x in columns.items()])
