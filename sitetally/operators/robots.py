"""Robots rules as tables: text to rules, permission of URLs, freshness of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.urls import unquote, url_path
from .skew import OrderedRows, lookup_join, micros_of


MANY_RULES = 200
RULE_COLUMNS = ("group_no", "agent", "rule_no", "allow", "prefix")
_BREAK = "\ue000"  # stands for a line break inside a decoded value


def robots_rules(robots: DataFrame) -> DataFrame:
    """Texts (``body`` beside any key columns such as ``host``) -> keys, ``group_no, agent, rule_no, allow, prefix``.

    A group is one or more agent lines and the rules after them; a blank line or an agent line after a rule ends it.
    Rules before any agent line are ignored; an empty ``Disallow`` allows everything. Each text is read inside its row:
    nothing is shuffled, and two texts of one host stay apart.
    """
    keys = [c for c in robots.columns if c != "body"]

    def line(raw, i):
        content = F.trim(F.regexp_replace(raw, "#.*$", ""))
        field = F.lower(F.trim(F.regexp_extract(content, "^([^:]*):", 1)))
        value = F.replace(unquote(F.trim(F.regexp_extract(content, "^[^:]*:(.*)$", 1))), F.lit("\n"), F.lit(_BREAK))
        rule = F.concat_ws("\t", F.lit("R"), i.cast("string"), field, value)
        return (F.when(raw == "", "B").when(field == "user-agent", F.concat(F.lit("A\t"), F.lower(value)))
                .when(field.isin("allow", "disallow", "crawl-delay", "request-rate"), rule))

    marked = F.array_join(F.filter(F.transform(F.split("body", "\r\n|\r|\n"), line), lambda x: x.isNotNull()), "\n")
    # groups part at blank lines, and where an agent follows a rule
    parted = F.regexp_replace(F.concat(marked, F.lit("\n")), r"(?m)(^R\t[^\n]*\n)(?=A\t)", "$1B\n")
    groups = robots.select(*keys, F.posexplode(F.split(parted, r"(?m)^B\n")).alias("group_no", "part"))

    def starting(mark):
        return F.filter(F.split("part", "\n"), lambda x: x.startswith(mark))

    def rule_of(x):
        cells = F.split(x, "\t", 4)
        value = F.replace(F.get(cells, 3), F.lit(_BREAK), F.lit("\n"))
        return F.named_struct(F.lit("rule_no"), F.get(cells, 1).cast("int"), F.lit("allow"),
                              (F.get(cells, 2) == "allow") | (value == ""), F.lit("prefix"), value)

    allowing = F.filter(starting("R\t"), lambda x: F.get(F.split(x, "\t", 4), 2).isin("allow", "disallow"))
    # a group that only sets a delay still answers for its agents, with no rule
    rows = groups.where(F.size(starting("R\t")) > 0).select(
        *keys, "group_no", F.explode(F.transform(starting("A\t"), lambda x: F.substr(x, F.lit(3)))).alias("agent"),
        F.transform(allowing, rule_of).alias("rules"))
    return rows.select(*keys, "group_no", "agent", F.inline_outer("rules"))


def rules_for_status(robots: DataFrame, server_error_denies: bool = True) -> DataFrame:
    """Texts with ``status``, the body replaced where the status decides.

    401 and 403 deny everything, a missing text (404 and other client errors) allows everything, and a server error or
    no answer denies unless told otherwise.
    """
    deny, allow = F.lit("User-agent: *\nDisallow: /"), F.lit("")
    s = F.col("status")
    body = (
        F.when(s.isin(401, 403), deny)
        .when(s.between(400, 499), allow)
        .when(s.isNull() | (s >= 500), deny if server_error_denies else allow)
        .otherwise(F.col("body")))
    return robots.withColumn("body", body).drop("status")


def rules_for_agent(rules: DataFrame, agent: str) -> DataFrame:
    """The rules each text applies to one agent, in order, as one row per text (its key columns).

    The first group naming the agent counts, else the first group for ``*``.
    """
    keys = [c for c in rules.columns if c not in RULE_COLUMNS]
    product = agent.split("/")[0].lower()
    named = F.lit(product).contains(F.col("agent")) & (F.col("agent") != "*")
    rule = F.struct("rule_no", "allow", "prefix")
    groups = rules.groupBy(*keys, "group_no").agg(
        F.bool_or(F.col("agent") == "*").alias("star"), F.bool_or(named).alias("named"),
        F.array_sort(F.collect_set(F.when(F.col("rule_no").isNotNull(), rule))).alias("rules"))
    rank = F.when(F.col("star"), 2).when(F.col("named"), 1)
    return groups.where(rank.isNotNull()).groupBy(*keys).agg(F.min_by("rules", F.struct(rank, "group_no")).alias("rules"))


def _first_by_prefix(asked: DataFrame, agent_rules: DataFrame) -> DataFrame:
    """``host, path`` -> the first rule whose prefix starts the path, by equality of prefixes.

    A path is cut at every length that a prefix of its host has; a host's rules never meet in one row or task.
    """
    first = agent_rules.select("host", F.inline("rules")).groupBy("host", "prefix").agg(F.min(F.struct("rule_no", "allow")).alias("first"))
    lengths = agent_rules.select("host", F.array_distinct(F.transform("rules", lambda r: F.length(r["prefix"]))).alias("lengths"))
    cuts = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substr("path", F.lit(1), n))
    tried = asked.distinct().join(lengths, "host").select("host", "path", F.explode(cuts).alias("prefix"))
    return tried.join(first, ["host", "prefix"]).groupBy("host", "path").agg(F.min("first").alias("match"))


def robots_allowed(urls: DataFrame, agent_rules: DataFrame, url: str, many: int = MANY_RULES) -> DataFrame:
    """Adds ``rule_no`` and ``allowed``: the first rule whose prefix starts the path decides; without one, allowed.

    Rules of a host with up to ``many`` of them go along with its URLs as a list; those of larger hosts are joined by prefix.
    """
    urls = urls.withColumn("path", unquote(url_path(F.col(url))))
    matching = F.filter("rules", lambda r: F.col("path").startswith(r["prefix"]))
    few, more = (agent_rules.where(test) for test in (F.size("rules") <= many, F.size("rules") > many))
    joined = lookup_join(urls, few, "host").withColumn("match", F.try_element_at(matching, F.lit(1))).drop("rules")
    match = F.struct(F.col("match.rule_no").alias("rule_no"), F.col("match.allow").alias("allow"))
    joined = joined.withColumn("match", F.when(F.col("match").isNotNull(), match))
    if not more.isEmpty():
        far = _first_by_prefix(urls.select("host", "path"), more).withColumnRenamed("match", "far")
        joined = joined.join(far, ["host", "path"], "left").withColumn("match", F.coalesce("match", "far")).drop("far")
    return joined.withColumns({"rule_no": F.col("match.rule_no"), "allowed": F.coalesce("match.allow", F.lit(True))}).drop("match", "path")


def robots_asof(requests: DataFrame, snapshots: DataFrame, ttl_seconds: float = params.ROBOTS_TTL_SECONDS, segments: int | None = None) -> DataFrame:
    """Latest snapshot at or before each request, and whether it is younger than the time to live.

    Both inputs: ``host, ts, id``. One pass over both in time order instead of a range join.
    """
    def timed(df: DataFrame, kind: int) -> DataFrame:
        return df.select("host", "ts", F.lit(kind).alias("kind"), "id", micros_of(df, "ts").alias("us"))

    both = timed(snapshots, 0).unionByName(timed(requests, 1))
    snap = F.when(F.col("kind") == 0, F.struct(F.col("us"), F.col("id")))
    rows = OrderedRows.of(both, ["host"], ["ts", "kind", "id"], segments).last_known({"snap": snap}).rows()
    age = (F.col("us") - F.col("snap.us")) / F.lit(1e6)
    return rows.where(F.col("kind") == 1).select(
        "host", F.col("id").alias("request_id"), F.col("snap.id").alias("snapshot_id"), age.alias("age_seconds"),
        F.coalesce(age >= F.lit(float(ttl_seconds)), F.lit(True)).alias("needs_refresh"))
