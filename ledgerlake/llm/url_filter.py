"""URL filter: explicit rules first, else logistic regression on character n-grams.

The model is a logistic regression on hashed character 3- to 5-grams of host and path
(``FEATURES`` slots, each n-gram counts once), trained with gradient descent on a small
labelled URL table (``labelled_urls``).  A URL is blocked from a probability of 0.5.

Rules (verdict, host, path): a rule fits its host and every subdomain, if the URL's path
starts with the rule's path; the longest host and path wins, ties go to ``block``.

NULL URLs and URLs without ``://`` have an empty host and path; without a rule they are
allowed, as there is nothing to judge.  Very long URLs are read whole.  Repeated rows are
judged alike; other columns are ignored.
"""

from __future__ import annotations

import string
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlake.session import ship_package

#: Wide enough that n-grams of hosts, of paths and of other URLs seldom share a slot.
FEATURES = 1 << 16
SIZES = (3, 4, 5)
#: Rules as (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Fixed values, written by hand and not taken from any URL table: words of hosts to block
#: (gambling, pills, loans, adult, malware, advertising) and of hosts to allow.
BLOCK_WORDS = ["casino", "poker", "betting", "jackpot", "lottery", "slots", "win", "roulette",
               "bingo", "pills", "pharmacy", "viagra", "cialis", "slimming", "cheap", "discount", "payday",
               "loans", "bonus", "free-money", "adult", "xxx", "porn", "escort", "spam",
               "clickbait", "popunder", "replica", "torrent", "warez", "keygen", "malware",
               "phishing"]
ALLOW_WORDS = ["news", "blog", "library", "university", "museum", "weather", "recipes", "garden",
               "history", "science", "physics", "archive", "travel", "forum", "docs", "health",
               "music", "cinema", "school", "council", "river", "theatre", "bakery", "bridge",
               "carpenter", "chemistry", "church", "coffee", "computer", "cycling", "dance",
               "dentist", "energy", "engineer", "farmers", "festival", "fishing", "football",
               "forest", "furniture", "gallery", "harbour", "hospital", "hotel", "island",
               "journal", "kitchen", "language", "lawyer", "magazine", "market", "mathematics",
               "mountain", "northern", "office", "orchestra", "painting", "parish", "photo",
               "planet", "poetry", "radio", "railway", "research", "restaurant", "sailing",
               "society", "software", "station", "student", "teacher", "transport", "village",
               "winter", "workshop", "building", "camera", "castle", "evening", "driving", "anderson", "bennett", "fischer", "garcia", "henderson",
               "johansson", "martin", "nguyen", "rossi", "schneider", "williams", "berlin",
               "london", "madrid", "toronto", "1984", "2020", "365", "42", "archive7"]
#: Neutral paths, dealt alike to the hosts of both classes.
PATHS = ["/", "/en/12.html", "/de/804/", "/fr/33", "/es/7", "/2021/05/12"]
#: Fixed values, written by hand: words of paths to block and of paths to allow.
BLOCK_PATHS = ["casino", "poker", "jackpot", "lottery", "roulette", "betting", "freespins",
               "bonus-code", "viagra", "pharmacy", "weightloss", "payday-loan", "porn", "xxx",
               "adult", "escorts", "hookup", "warez", "crack", "keygen", "torrent", "phish",
               "malware", "replica"]
ALLOW_PATHS = ["news", "article", "about", "contact", "products", "docs", "help", "wiki",
               "recipes", "research", "events", "calendar", "courses", "library", "gallery",
               "archive", "reports", "travel", "weather", "sports", "science", "history",
               "music", "books", "tags", "category", "search", "index.html", "download",
               "support", "team", "careers", "press", "privacy", "forum", "blog", "questions",
               "guide", "manual", "story"]
#: Neutral hosts, dealt alike to the paths of both classes.
HOSTS = ["site.example.org", "www.home.example.net", "portal.example.com", "my.pages.example.org"]


def labelled_urls() -> list[tuple[str, str, int]]:
    """The labelled table (host, path, 1: block), built from the words above by a rule.

    Words of hosts stand on neutral paths and words of paths on neutral hosts, so each
    n-gram learns from its own half.
    """
    out = []
    for words, label in ((BLOCK_WORDS, 1), (ALLOW_WORDS, 0)):
        for i, w in enumerate(words):
            other = words[(i * 7 + 3) % len(words)]
            hosts = [f"{w}.example.org", f"www.{w}-{other}.example.net", f"m.{other}-{w}.example.com",
                     f"blog.{w}.example.com"]
            out += [(h, PATHS[(i + j) % len(PATHS)], label) for j, h in enumerate(hosts)]
    for words, label in ((BLOCK_PATHS, 1), (ALLOW_PATHS, 0)):
        for i, w in enumerate(words):
            other = words[(i * 7 + 3) % len(words)]
            out.append((HOSTS[i % len(HOSTS)], f"/{other}/{w}", label))
    return out


def slots(host: str, path: str) -> list[int]:
    """Distinct feature slots of the n-grams of host and path (each marked as such)."""
    out = set()
    for mark, s in (("h", f"^{host}$"), ("p", f"{path}$")):
        if len(s) < 2 + (mark == "h"):
            continue
        for k in SIZES:
            out.update(zlib.crc32(f"{mark}{s[i:i + k]}".encode()) % FEATURES
                       for i in range(max(len(s) - k + 1, 1)))
    return sorted(out)


@lru_cache(maxsize=1)
def trained(steps: int = 1000, rate: float = 1.0, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias."""
    return fit(labelled_urls(), steps, rate, l2)


def fit(rows: list[tuple[str, str, int]], steps: int = 1000, rate: float = 1.0,
        l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias learned from (host, path, label) rows; slots in no row weigh 0."""
    sets = [slots(host, path) for host, path, _ in rows]
    used = np.unique(np.concatenate(sets))
    x = np.zeros((len(rows), len(used)))
    for i, s in enumerate(sets):
        x[i, np.searchsorted(used, s)] = 1 / np.sqrt(len(s))
    y = np.array([r[2] for r in rows], dtype=float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b = np.zeros(len(used)), 0.0
    for _ in range(steps):
        e = (1 / (1 + np.exp(-(x @ w + b))) - y) * weight
        w -= rate * 20 * (x.T @ e + l2 * w / 20)
        b -= rate * e.sum()
    full = np.zeros(FEATURES)
    full[used] = w
    return full, b


def probability(host: str, path: str, model: tuple[np.ndarray, float]) -> float:
    s = slots(host, path)
    if not s:
        return 0.0
    w, b = model
    return float(1 / (1 + np.exp(-(w[s].sum() / np.sqrt(len(s)) + b))))


def host_of(url: Column) -> Column:
    """After the first ://, up to /, ?, # or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block"))
    for verdict, h, p in order:  # later ones are longer and stand before the earlier
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"),
                                    F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability (the method's, for every URL)."""
    ship_package(pages.sparkSession)
    model = trained()

    @pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([probability(h, p, model) for h, p in zip(hosts, paths)], dtype=float)

    x = (pages.select("page_id", host_of(F.col("url")).alias("host"),
                      path_of(F.col("url")).alias("path"))
         .withColumn("block_probability", score("host", "path"))
         .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)))
    return x.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                    F.coalesce(F.col("_rule.verdict"),
                               F.when(F.col("block_probability") >= 0.5, "block")
                               .otherwise("allow")).alias("verdict"), "block_probability")
