"""URL filters: pattern rules indexed by their rarest literal token.

A host rule is a host and the start of a path: it fits the host and its subdomains. A text rule is
a piece of a url, where `*` stands for anything. Both become regular expressions. A rule's literal
tokens are its runs of ASCII letters and digits that stand alone in every url that it fits. Each rule
is filed under the one that is rarest in the urls; a rule without any is filed under the empty
token, which every url has. The tokens of a url fetch its candidate rules; only those run.

Different urls are judged once each, so a hot url is one row, and the verdict goes back to the
pages by a join on the url. The index is sent to all tasks while it has at most `broadcast_rules`
rules and is shuffled by token beyond that.

The verdict is that of the longest host rule; without one, `block` if a text rule fits, else `allow`.
Null urls and urls without "://" have an empty host and path and no rule. Repeated pages give one row each.
Of equally long host rules the first by name wins. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_RULES = 50_000
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOKEN = "[a-z0-9]+"

#: The host rules of the registered query.
HOST_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Pieces of urls that are not worth reading: sellers, doorways, sessions, machine pages.
TEXT_RULES = [
    "cheap-pills.", "spam-farm.", "-casino.", ".casino.", "online-poker.", "free-money.", "adult-dating.",
    "/wp-login.php", "/cgi-bin/", "/cart/checkout", "?phpsessid=", "&phpsessid=", "/feed/rss*.xml",
    "click-here.", "xxx-",
]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, CAPITALS, CAPITALS.lower())


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def rules_of(spark, host_rules=HOST_RULES, text_rules=TEXT_RULES) -> DataFrame:
    """(rule, verdict, whole, pattern, literals): `whole` rules are matched with host and path,
    the others with the lowered url."""
    hosts = spark.createDataFrame([*host_rules] or [("", "", "")], "host string, path string, verdict string")
    hosts = hosts.where("host <> ''").select(
        F.concat("host", "path").alias("rule"), "verdict", F.lit(True).alias("whole"), "host", "path")
    host = hosts.select(
        "rule", "verdict", "whole",
        F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), quoted(F.col("rule"))).alias("pattern"),
        # The start of a host stands alone, as a dot or nothing comes before it.
        F.regexp_extract_all(F.concat(F.lit("."), F.lower("rule")),
                             F.lit(r"(?<![a-z0-9])([a-z0-9]+)(?=[^a-z0-9])"), 1).alias("literals"))
    texts = spark.createDataFrame([(t,) for t in text_rules] or [("",)], "rule string").where("rule <> ''")
    text = texts.select(
        F.lower("rule").alias("rule"), F.lit("block").alias("verdict"), F.lit(False).alias("whole"),
        F.concat(F.lit("(?s)"), F.array_join(F.transform(
            F.split(F.lower("rule"), r"\*"), quoted), ".*")).alias("pattern"),
        F.regexp_extract_all(F.lower("rule"), F.lit(r"(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"), 1).alias("literals"))
    return host.unionByName(text).dropDuplicates(["rule", "whole"])


def quoted(text: Column) -> Column:
    """The text as a regular expression that matches it alone."""
    return F.when(text == "", F.lit("")).otherwise(
        F.regexp_replace(text, r"([^A-Za-z0-9])", r"\\$1"))


def tokens_of(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(subject), F.lit(f"({TOKEN})"), 1))


def index_of(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """rules with `token`: the literal that the fewest urls have; of equal ones the first by name."""
    literals = rules.select("rule", "whole", F.explode("literals").alias("token"))
    known = literals.select("token").distinct()
    rarity = (urls.select(F.explode("tokens").alias("token")).join(known, "token", "left_semi")
              .groupBy("token").agg(F.count("*").alias("n")))
    rarest = (literals.join(rarity, "token", "left").groupBy("rule", "whole")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least")))
    return rules.join(rarest, ["rule", "whole"], "left").select(
        "rule", "verdict", "whole", "pattern", F.coalesce("least.token", F.lit("")).alias("token"))


def judge(pages: DataFrame, rules: DataFrame, *, page_id: str = "page_id", url: str = "url",
          broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """Per page: (page_id, host, path, rule, verdict). rules: as rules_of gives them."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    urls = rows.where("url IS NOT NULL").select("url").distinct().select(
        "url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("place"),
        tokens_of(F.col("url")).alias("tokens"))
    index = index_of(rules, urls)
    if rules.count() <= broadcast_rules:
        index = F.broadcast(index)
    candidates = urls.select("url", "place", F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token")).join(index, "token")
    fitting = candidates.where(F.when(F.col("whole"), F.expr("place RLIKE pattern")).otherwise(
        F.expr("lower(url) RLIKE pattern")))
    best = F.max(F.when(F.col("whole"), F.struct(F.length("rule").alias("size"), "rule", "verdict")))
    found = fitting.groupBy("url").agg(best.alias("best"), F.max(~F.col("whole")).alias("listed"))
    return rows.join(found, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("listed"), "block"), F.lit("allow")).alias("verdict"))


def oracle(host_rules=HOST_RULES, text_rules=TEXT_RULES) -> str:
    """The same rows from DuckDB, every rule tried on every url."""
    hosts = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in host_rules)
    texts = ", ".join(f"('{t.lower().replace('*', '%')}')" for t in text_rules)
    return f"""
WITH host_rules(h, p, verdict) AS (VALUES {hosts}),
text_rules(t) AS (VALUES {texts}),
parts AS (
  SELECT row_number() OVER () AS n, page_id, lower(coalesce(url, '')) AS low, instr(coalesce(url, ''), '://') AS at,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT n, page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{CAPITALS}', '{CAPITALS.lower()}') AS host,
         substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path
  FROM parts),
best AS (
  SELECT n, max({{'size': length(h || p), 'rule': h || p, 'verdict': verdict}}) AS b
  FROM split JOIN host_rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY n)
SELECT page_id, host, path, b.rule AS rule,
       coalesce(b.verdict, CASE WHEN EXISTS (SELECT 1 FROM text_rules WHERE low LIKE '%' || t || '%')
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN best USING (n)"""
