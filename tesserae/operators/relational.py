"""Joins, merges and winners over keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered

C = F.col


def stale(entries: DataFrame, template: DataFrame, key: str = "msgid") -> DataFrame:
    """Entries whose key the template no longer has."""
    return entries.join(template.select(key).distinct(), key, "left_anti")


def live(entries: DataFrame, template: DataFrame, key: str = "msgid") -> DataFrame:
    return entries.join(template.select(key).distinct(), key, "left_semi")


def without_done(wanted: DataFrame, done: DataFrame, key: str = "msgid") -> DataFrame:
    """What a resumed run has still to do."""
    return stale(wanted, done, key)


def merged(template: DataFrame, catalogue: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, status: kept, new (in the template alone) or obsolete (in the catalogue alone)."""
    t = template.select(C(key).alias("_k"), F.lit(True).alias("_in"))
    c = catalogue.select(key, value, F.lit(True).alias("_has"))
    both = t.join(c, C("_k") == C(key), "full_outer")
    status = F.when(C("_has").isNull(), "new").when(C("_in").isNull(), "obsolete").otherwise("kept")
    return both.select(F.coalesce("_k", key).alias(key), C(value), status.alias("status"))


def registry_diff(existing: DataFrame, upstream: DataFrame, key: str, value: str, normal: Column | None = None) -> DataFrame:
    """key, old_value, new_value, status of two maps: added, updated, removed, unchanged.

    Keys are compared in lower case; `normal` is the value in the form that is compared, applied to both sides.
    """
    normal = C(value) if normal is None else normal
    old = existing.select(F.lower(key).alias("_k"), normal.alias("old_value"), F.lit(True).alias("_o"))
    new = upstream.select(F.lower(key).alias("key"), normal.alias("new_value"), F.lit(True).alias("_n"))
    status = F.when(C("_o").isNull(), "added").when(C("_n").isNull(), "removed").when(C("old_value").eqNullSafe(C("new_value")), "unchanged").otherwise("updated")
    return old.join(new, C("_k") == C("key"), "full_outer").select(F.coalesce("key", "_k").alias("key"), "old_value", "new_value", status.alias("status"))


def guarded_sync(upstream: DataFrame, existing: DataFrame) -> DataFrame:
    """key, value, action from lookups that can fail.

    upstream: key, server (null: none), failed, reachable (the new server's). existing: key, old_server, old_reachable. A failed lookup changes nothing; a new server
    counts only if reachable; an old one goes only if upstream has none and it is unreachable itself.
    """
    both = upstream.join(existing.withColumnRenamed("key", "_k"), C("key") == C("_k"), "left")
    action = (
        F.when(C("failed"), "untouched")
        .when(C("server").isNotNull() & C("old_server").isNull(), F.when(C("reachable"), "added").otherwise("skipped"))
        .when(C("server").isNotNull() & (C("server") == C("old_server")), "unchanged")
        .when(C("server").isNotNull(), F.when(C("reachable"), "updated").otherwise("skipped"))
        .when(C("old_server").isNotNull(), F.when(C("old_reachable"), "kept").otherwise("removed"))
        .otherwise("none")
    )
    value = F.when(C("action").isin("added", "updated"), C("server")).when(C("action") == "removed", None).otherwise(C("old_server"))
    return both.withColumn("action", action).select("key", value.alias("value"), "action")


def filled(entries: DataFrame, fallback: DataFrame, key: str, value: str, flag: str = "auto-english-fallback") -> DataFrame:
    """Empty values from the fallback's value of the key; filled rows carry the flag."""
    f = fallback.select(C(key).alias("_k"), C(value).alias("_v"))
    empty = F.coalesce(C(value), F.lit("")) == ""
    out = entries.join(f, C(key) == C("_k"), "left")
    gets = empty & (F.coalesce(C("_v"), F.lit("")) != "")
    return out.select(*[c for c in entries.columns if c != value], F.when(gets, C("_v")).otherwise(C(value)).alias(value), F.when(gets, F.lit(flag)).alias("flag"))


def prioritised(entries: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """value from `first` where it has the key, else from `second`, else as it is."""
    a = first.select(C(key).alias("_ka"), C(value).alias("_va"))
    b = second.select(C(key).alias("_kb"), C(value).alias("_vb"))
    out = entries.join(a, C(key) == C("_ka"), "left").join(b, C(key) == C("_kb"), "left")
    return out.select(*[c for c in entries.columns if c != value], F.coalesce("_va", "_vb", value).alias(value))


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value))


def first_wins(sources: list[DataFrame], key: str) -> DataFrame:
    """Union of ordered sources; of rows with one key the earliest source's stays, then the least row."""
    ranked = None
    for i, s in enumerate(sources):
        part = s.withColumn("source_rank", F.lit(i))
        ranked = part if ranked is None else ranked.unionByName(part)
    rest = [c for c in ranked.columns if c not in (key, "source_rank")]
    best = ranked.groupBy(key).agg(F.min(F.struct("source_rank", *rest)).alias("_b"))
    return best.select(key, "_b.source_rank", *[C(f"_b.{c}").alias(c) for c in rest])


def ranked_winners(proposals: DataFrame, key: str, family: str, text: str, order: list[str]) -> DataFrame:
    """key, text, n_overridden, conflict: of each key's proposals those of the family that comes last in `order` win;
    more than one text among them is a conflict, and the least is shown. Unknown families rank below all."""
    rank = F.lit(0)
    for i, name in enumerate(order, 1):
        rank = F.when(C(family) == name, F.lit(i)).otherwise(rank)
    rows = proposals.select(C(key), C(text).alias("_t"), rank.alias("_r")).groupBy(key, "_r").agg(F.min("_t").alias("_t"), F.count_distinct("_t").alias("_d"), F.count("*").alias("_n"))
    top = rows.groupBy(key).agg(F.max(F.struct("_r", "_t", "_d")).alias("_top"), F.sum("_n").alias("_all"), F.max_by("_n", "_r").alias("_own"))
    return top.select(key, C("_top._t").alias(text), (C("_all") - C("_own")).alias("n_overridden"), (C("_top._d") > 1).alias("conflict"))


def merged_locations(records: DataFrame, key: str, location: str, order: str) -> DataFrame:
    """One row for each key: its first place and all its locations in order, joined by a space."""
    pairs = F.array_sort(F.collect_list(F.struct(order, location)))
    return records.groupBy(key).agg(F.min(order).alias("first_pos"), F.count("*").alias("n"), F.array_join(F.transform(pairs, lambda x: x[location].cast("string")), " ").alias("locations"))


def line_spans(rows: DataFrame, path: str, pos: str, text: str) -> DataFrame:
    """Adds line_start and line_end, 1-based, of each row's text in its file: running sums of line feeds, by blocks of positions."""
    feeds = F.length(text) - F.length(F.replace(C(text), F.lit("\n")))
    out = ordered.running_sums(rows.withColumn("_feeds", feeds.cast("long")), [path], pos, {"line_start": C("_feeds") + 1})
    return out.withColumn("line_start", C("line_start") + 1).withColumn("line_end", C("line_start") + C("_feeds")).drop("_feeds")


def line_owners(lines: DataFrame, spans: DataFrame, path: str, line: str) -> DataFrame:
    """The row of spans that holds each line, or else the nearest before it.

    An as-of join by merge: spans and lines of a file in one order, the last span carried forward from block to block; no pair is tried.
    """
    s = spans.select(path, (2 * C("line_start")).alias("_at"), F.struct(*[c for c in spans.columns if c != path]).alias("_span"), F.lit(None).cast(lines.schema[line].dataType).alias(line))
    q = lines.select(path, (2 * C(line).cast("long") + 1).alias("_at"), F.lit(None).cast(s.schema["_span"].dataType).alias("_span"), line)
    own = ordered.carried(s.unionByName(q), [path], "_at", {"_own": C("_span")})
    return own.filter(C("_at") % 2 == 1).select(path, line, "_own.*")


def changed_keys(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """key and what happened to it between two snapshots; equal rows are left out."""
    return registry_diff(before, after, key, value).filter(C("status") != "unchanged")


def audited_changes(before: DataFrame, after: DataFrame, planned: DataFrame, key: str, value: str, others: list[str] = ()) -> DataFrame:
    """key, problem of a rewrite held against its plan: lost or new (a key is in one snapshot alone), unexpected (value changed, key not planned), missed (planned, value
    as before) or spilled (one of `others` changed). Snapshots meet by full outer join; values are compared null with null. No rows if all went as planned."""
    a = before.select(C(key).alias("_ka"), C(value).alias("_va"), *[C(c).alias(f"_a_{c}") for c in others], F.lit(True).alias("_in_a"))
    b = after.select(C(key).alias("_kb"), C(value).alias("_vb"), *[C(c).alias(f"_b_{c}") for c in others], F.lit(True).alias("_in_b"))
    p = planned.select(C(key).alias("_kp")).distinct()
    rows = a.join(b, C("_ka") == C("_kb"), "full_outer").withColumn("_k", F.coalesce("_ka", "_kb")).join(p, C("_k") == C("_kp"), "left")
    changed = ~C("_va").eqNullSafe(C("_vb"))
    spilled = F.lit(False)
    for c in others:
        spilled = spilled | ~C(f"_a_{c}").eqNullSafe(C(f"_b_{c}"))
    problems = F.array(
        F.when(C("_in_b").isNull(), "lost").when(C("_in_a").isNull(), "new").when(changed & C("_kp").isNull(), "unexpected").when(~changed & C("_kp").isNotNull(), "missed"),
        F.when(C("_in_a").isNotNull() & C("_in_b").isNotNull() & spilled, "spilled"),
    )
    return rows.select(C("_k").alias(key), F.explode(F.array_compact(problems)).alias("problem"))


def address_number(address: Column) -> Column:
    """An IPv4 address as a bigint, null for any other text."""
    parts = F.split(address, r"\.")
    part = lambda k: F.get(parts, k).try_cast("long")
    fits = address.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}(?<!\.)$")
    return F.when(fits, ((part(0) * 256 + part(1)) * 256 + part(2)) * 256 + part(3))


def bypassed(hosts: DataFrame, rules: DataFrame, host: str = "host", rule: str = "rule") -> DataFrame:
    """Distinct (host, rule): the rules of a bypass list that a host falls under.

    A rule is an address, a network in CIDR form, a host name, or a domain with a dot (or `*.`) in front for all below it, without regard to case; `*` is for all hosts. No rule is
    tried against every host: an address is looked up under each length of network that there is, a name under each domain it is in.
    """
    h = hosts.select(F.lower(F.trim(host)).alias("host")).filter(C("host") != "").distinct()
    r = rules.select(C(rule).alias("rule"), F.lower(F.trim(rule)).alias("_r")).distinct()
    form = r"^([0-9.]+)/([0-9]|[12][0-9]|3[0-2])$"
    base, length = address_number(F.regexp_extract("_r", form, 1)), F.regexp_extract("_r", form, 2).try_cast("int")
    net = r.withColumns({"_base": F.coalesce(base, address_number(C("_r"))), "_bits": F.coalesce(length, F.lit(32))}).filter(C("_base").isNotNull())
    size = F.expr("shiftleft(1L, 32 - _bits)")
    net = net.select("rule", "_bits", F.floor(C("_base") / size).alias("_net"))
    lengths = F.broadcast(net.select("_bits").distinct())  # at most 33 rows
    own = h.withColumn("_a", address_number(C("host"))).filter(C("_a").isNotNull()).crossJoin(lengths).withColumn("_net", F.floor(C("_a") / size))
    by_address = own.join(net, ["_bits", "_net"]).select("host", "rule")
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(2), F.size(labels)), lambda k: F.concat(F.lit("."), F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    names = h.select("host", F.explode(F.array_distinct(F.concat(F.array("host", F.concat(F.lit("."), "host"), F.lit("*")), F.when(F.size(labels) > 1, above).otherwise(F.array().cast("array<string>"))))).alias("_name"))
    named = r.select("rule", F.regexp_replace("_r", r"^\*\.", ".").alias("_name"))
    return by_address.unionByName(names.join(named, "_name").select("host", "rule")).distinct()


def kept_first(rows: DataFrame, bucket: str | list[str], order: str, n: int) -> DataFrame:
    """The first n rows of each bucket by `order`; all for n = 0."""
    if not n:
        return rows
    w = Window.partitionBy(bucket).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).filter(C("_n") <= n).drop("_n")


def staleness(sources: DataFrame, compiled: DataFrame, key: str, at: str) -> DataFrame:
    """key, state: missing (no compiled row), outdated (compiled before the source), or fresh."""
    c = compiled.select(C(key).alias("_k"), C(at).alias("_at"))
    state = F.when(C("_at").isNull(), "missing").when(C(at) > C("_at"), "outdated").otherwise("fresh")
    return sources.join(c, C(key) == C("_k"), "left").select(key, state.alias("state"))
