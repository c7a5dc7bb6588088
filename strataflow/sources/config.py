"""Registry and rule packs (SRC-01..04, SRC-13, SRC-15)."""

from __future__ import annotations

import json
import re
import subprocess
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions.scalars import casefold
from strataflow.operators.screen import RulePack


@dataclass(frozen=True)
class Journal:
    key: str
    title: str
    pubmed_title: str
    tier: str
    tracks: tuple[str, ...]
    priority: float


@dataclass(frozen=True)
class Registry:
    """Ordered, unique entries of a versioned registry."""

    version: str
    effective_from: str
    journals: tuple[Journal, ...]

    def __post_init__(self) -> None:
        for name in ("key", "title"):
            values = [getattr(j, name).casefold() if name == "title" else j.key for j in self.journals]
            if len(set(values)) != len(values):
                raise ValueError(f"registry {name}s must be unique")
        order = [j.priority for j in self.journals]
        if order != sorted(order):
            raise ValueError("registry priorities must ascend")

    def by_key(self, key: str) -> Journal:
        found = [j for j in self.journals if j.key == key]
        if not found:
            raise ValueError(f"unknown journal {key!r}; known: {', '.join(sorted(j.key for j in self.journals))}")
        return found[0]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(j.key, j.title, j.pubmed_title, j.tier, list(j.tracks), j.priority) for j in self.journals]
        return spark.createDataFrame(rows, "key string, title string, pubmed_title string, tier string, tracks array<string>, priority double")


def read_object(path: str | Path) -> dict:
    value = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise ValueError(f"{path}: the top level must be an object")
    return value


def load_registry(path: str | Path) -> Registry:
    raw = read_object(path)
    rows = tuple(Journal(j["key"], j["title"], j["pubmed_title"], j["tier"], tuple(j["tracks"]), float(j["priority"])) for j in raw["journals"])
    return Registry(raw["version"], raw.get("effective_from", ""), rows)


def load_rules(path: str | Path) -> RulePack:
    raw = read_object(path)
    for p in (*raw["cancer"], *raw["omics"]):
        re.compile(p)
    return RulePack(raw["version"], tuple(raw["cancer"]), tuple(raw["omics"]))


def without_blacklisted(journals: DataFrame, blacklist: DataFrame, whitelist: DataFrame | None = None) -> DataFrame:
    """Entries whose title is not blacklisted; a whitelisted title stays in any case (SRC-15, STA-13)."""
    title = F.lower("title")
    banned = blacklist.select(title.alias("__t")).distinct()
    if whitelist is not None:
        banned = banned.join(whitelist.select(title.alias("__t")), "__t", "left_anti")
    return journals.withColumn("__t", title).join(banned, "__t", "left_anti").drop("__t")


@dataclass(frozen=True)
class JournalPolicy:
    """Titles and publisher families that are left out, and whether a whitelisted title stays in any case."""

    exact: tuple[str, ...]
    families: tuple[str, ...]
    whitelist_precedence: bool = True
    whitelist_only: bool = True


def load_policy(path: str | Path) -> JournalPolicy:
    raw = read_object(path)
    said = raw["policy"]
    return JournalPolicy(tuple(raw["exact_journals"]), tuple(raw["publisher_families"]), bool(said["whitelist_precedence"]), said["mode"] == "whitelist_only")


def policy_rules(spark: SparkSession, policy: JournalPolicy) -> DataFrame:
    """A policy's exclusions as rows of ``kind`` (title or publisher) and ``name``."""
    return spark.createDataFrame([("title", x) for x in policy.exact] + [("publisher", x) for x in policy.families], "kind string, name string")


def journal_actions(journals: DataFrame, rules: DataFrame, whitelist: DataFrame, whitelist_precedence: bool = True, whitelist_only: bool = True) -> DataFrame:
    """``journals`` (title, publisher and others) with ``action``, include or exclude, and the ``reason`` that decided (SRC-15, STA-13).

    A whitelisted title (``whitelist`` has ``title``) comes first, or with ``whitelist_precedence`` False last; then a title that is
    left out by name; then its publisher's family; what nothing names is left out only if the policy is a whitelist. Names are
    compared without regard to case. Each journal is asked for under its title and its publisher, and the rules of all
    three kinds are found by one join, of which the one that comes first is kept.
    """
    first, last = ("a", "d") if whitelist_precedence else ("d", "a")
    listed = whitelist.select(F.lit("title").alias("__kind"), casefold(F.col("title")).alias("__name"), F.lit(first).alias("__rank"), F.lit("whitelisted").alias("__why")).distinct()
    rank, why = F.when(F.col("kind") == "title", "b").otherwise("c"), F.when(F.col("kind") == "title", F.lit("title is excluded")).otherwise(F.concat(F.lit("publisher family "), "name"))
    banned = rules.groupBy("kind", casefold(F.col("name")).alias("__name")).agg(F.min("name").alias("name")).select(F.col("kind").alias("__kind"), "__name", rank.alias("__rank"), why.alias("__why"))
    rows = journals.withColumn("__row", F.monotonically_increasing_id())
    asked = rows.select("__row", F.explode(F.array(F.struct(F.lit("title").alias("k"), F.col("title").alias("n")), F.struct(F.lit("publisher").alias("k"), F.col("publisher").alias("n")))).alias("x"))
    found = asked.select("__row", F.col("x.k").alias("__kind"), casefold(F.col("x.n")).alias("__name")).join(listed.unionByName(banned), ["__kind", "__name"]).groupBy("__row").agg(F.min(F.struct("__rank", "__why")).alias("__rule"))
    known = rows.join(found, "__row", "left")
    action = F.when(F.col("__rule.__rank") == first, "include").when(F.col("__rule").isNotNull(), "exclude").otherwise("exclude" if whitelist_only else "include")
    reason = F.coalesce("__rule.__why", F.lit("not whitelisted" if whitelist_only else "no rule"))
    return known.select(*journals.columns, action.alias("action"), reason.alias("reason"))


def software_revision(folder: str | Path = ".") -> str:
    """Commit of a working copy, ``unknown`` if there is none."""
    try:
        return subprocess.run(["git", "-C", str(folder), "rev-parse", "HEAD"], capture_output=True, text=True, check=True).stdout.strip() or "unknown"
    except (OSError, subprocess.CalledProcessError):
        return "unknown"
