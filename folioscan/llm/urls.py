"""URL filter: rules by host and path, and logistic regression on hashed character n-grams for the rest.

The n-grams of host and path (with marks at their ends) are hashed into one
vector of weights, fitted on a small labelled table of URLs. A table is given
here (url_labels); another can be passed. Scoring is one pass over a batch's
characters at once; nothing but the labels' sample is shuffled.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.llm.common import mixed, windows

#: Dimensions of the hashed n-grams, and their lengths in characters.
DIMENSIONS, LENGTHS = 1 << 17, (2, 3, 4, 5)
#: Marks before and after the host and after the path; no URL part holds them, as they aren't characters.
HOST, PATH, END = 0x110000, 0x110001, 0x110002


#: Words that name what a training corpus does without: gambling, pills, pornography, advertising, spam, piracy, easy money.
BLOCKED = (
    "casino poker roulette slots jackpot bingo lottery bet bets betting bookmaker wager win winner prize bonus "
    "pills pharmacy viagra cialis steroids dietpills adult porn xxx sex nude escort camgirls dating hookup "
    "ads adserver banner popup track tracker tracking clicks affiliate spam spammer linkfarm farm seo backlinks "
    "cheap discount replica fake free giveaway loans payday forex crypto scam phishing malware warez crack keygen torrent pirate"
).split()
#: Words of ordinary sites.
ALLOWED = (
    "news blog docs wiki library museum university school college science history music travel garden weather archive city "
    "journal research recipes kitchen sport theatre gallery church hospital engineering forum photo books poetry language "
    "family village transport railway energy climate physics chemistry biology law justice economy culture nature forest river "
    "tracks traction betterment alphabet exercise essex additive adverb winter windows pilgrim farmer freedom season cheapside"
).split()


def url_labels(seed: int = 1, rows: int = 4000) -> list[tuple[str, bool]]:
    """(url, blocked) by a rule over the words above: a third is blocked, by a word in the host or now and then the path.

    Subdomains, endings, languages and numbers are drawn alike for both kinds,
    and a good part of the allowed hosts is made of syllables, so that what is
    unknown counts as allowed.
    """
    r = random.Random(seed)
    syllables = [a + b for a, b in itertools.product("b c d f g h k l m n p r s t v w th sh ch st tr pl".split(), "a e i o u an en in on er ing ion ou ea".split())]
    made = lambda: "".join(r.choices(syllables, k=r.randint(2, 4)))
    out = []
    for k in range(rows):
        blocked = k % 3 == 0
        words = BLOCKED if blocked else ALLOWED
        part = lambda: r.choice(words) if blocked or r.random() < 0.4 else made()  # noqa: E731, B023
        shape = r.random()
        name = part() if shape < 0.4 else part() + "-" + r.choice([part(), made()]) if shape < 0.8 else part() + r.choice([part(), made()])
        where = f"/{r.choice(['en', 'de', 'fr', 'es', 'it'])}/{r.randrange(10 ** r.randint(2, 6))}" + r.choice(["", "/", ".html"])
        if r.random() < 0.3:
            where = "/" + r.choice(["", "articles/", "2021/04/", "posts/"]) + (name if r.random() < 0.5 else "-".join([part(), r.choice([part(), made()])])) + r.choice(["", "/", ".html"])
            if r.random() < 0.5:
                name = made()  # only the path says what it is
                where = "/" + "-".join([part(), part()]) + where if blocked else where
        out.append((f"https://{r.choice(['', '', 'www.', 'm.', 'blog.', 'shop.'])}{name}.{r.choice(['example.com', 'example.org', 'example.net', 'com', 'org', 'net', 'info', 'de', 'fr'])}{where}", blocked))
    return out


def labels_table(spark: SparkSession) -> DataFrame:
    """url_labels as a table."""
    return spark.createDataFrame(url_labels(), "url string, blocked boolean")


def host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, with A-Z in lower case; '' if there is none."""
    found = F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)([^?#]*)", 1), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end; '' without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)([^?#]*)", 2), F.lit(""))


def rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, as struct<rule, verdict>; null if none does.

    A rule is host/path...; it fits that host and its subdomains where the path
    starts with the rule's. Of rules of one length the one with the longer host
    holds, and then the greater one.
    """
    each = []
    for name, verdict in rules.items():
        at, sep, rest = name.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(sep + rest))
        each.append(F.when(fits, F.struct(F.lit(len(name)).alias("length"), F.lit(len(at)).alias("host"), F.lit(name).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*each)) if each else F.lit(None).cast("struct<length:int,host:int,rule:string,verdict:string>")


def grams(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For all n-grams of all URLs: the number of the URL and the n-gram's place in the weights.

    Host and path are one run of characters: mark, host, mark, path, mark; an
    n-gram may hold a mark at either end, and in between, so that the first
    part of a path is known as such.
    """
    parts = []
    for a, b in zip(hosts, paths, strict=True):
        parts += [np.array([HOST], "<u4"), np.frombuffer(a.encode("utf-32-le"), "<u4"), np.array([PATH], "<u4"), np.frombuffer(b.encode("utf-32-le"), "<u4"), np.array([END], "<u4")]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars = np.concatenate(parts)
    starts = chars == HOST
    row = np.cumsum(starts) - 1
    # whether a character belongs to the path: its n-grams are other features than the host's
    within = np.cumsum(chars == PATH) > row
    base = mixed(chars.astype(np.uint64) << np.uint64(1) | within.astype(np.uint64))
    rows, at = [], []
    for width in LENGTHS:
        n = len(chars) - width + 1
        if n <= 0:
            continue
        same = row[:n] == row[width - 1 :]
        rows.append(row[:n][same])
        at.append((windows(base, width, seed=width)[same] % np.uint64(DIMENSIONS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(at)


def logits(weights: np.ndarray, bias: float, hosts: list[str], paths: list[str]) -> np.ndarray:
    """The scorer's values: the mean weight of a URL's n-grams times the root of their number, and the bias."""
    row, at = grams(hosts, paths)
    number = np.maximum(np.bincount(row, minlength=len(hosts)), 1)
    return np.bincount(row, weights[at], len(hosts)) / np.sqrt(number) + bias


def fit(rows: list[tuple[str, str, bool]], rounds: int = 300, rate: float = 0.3, decay: float = 0.003) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch AdaGrad on (host, path, blocked) rows."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    target = np.array([r[2] for r in rows], float)
    if not len(rows) or target.min() == target.max():
        return weights, bias if not len(rows) else (5.0 if target[0] else -5.0)
    row, at = grams([r[0] for r in rows], [r[1] for r in rows])
    value = (1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(rows)), 1)))[row]
    share = 1 / len(rows)
    power, power_bias = np.full(DIMENSIONS, 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(row, weights[at] * value, len(rows)) + bias
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * share
        g = np.bincount(at, miss[row] * value, DIMENSIONS) + decay * weights / len(rows)
        power += g * g
        power_bias += miss.sum() ** 2
        weights -= rate * g / np.sqrt(power)
        bias -= rate * miss.sum() / np.sqrt(power_bias)
    return weights, float(bias)


def sampled(labelled: DataFrame, sample: int) -> list[tuple[str, str, bool]]:
    """At most `sample` distinct (host, path, blocked) rows, those with the smallest hashes.

    The hashes of distinct URLs are counted first (partial aggregation in the
    tasks, so a URL that stands in a third of all rows is one row of each).
    """
    key = F.xxhash64("host", "path")
    picked = labelled.groupBy("host", "path").agg(F.max("blocked").alias("blocked")).orderBy(key, "host", "path").limit(sample)
    return [(r["host"], r["path"], r["blocked"]) for r in picked.collect()]


def url_rules(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, and rule and verdict of the longest rule that fits (null where none does), for each row of pages."""
    url = F.col(f"`{url_col}`").cast("string")
    parted = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host(url).alias("host"), path(url).alias("path")).withColumn("found", rule(F.col("host"), F.col("path"), rules))
    return parted.select("page_id", "host", "path", "found.rule", "found.verdict")


def url_filter(pages: DataFrame, rules: dict[str, str], labelled: DataFrame, sample: int = 4096, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of pages: page_id, host, path, rule, verdict, score.

    verdict: that of the longest rule that fits, else block where the scorer's
    P(block), the column score, is above threshold, else allow. labelled: the
    table (url, blocked boolean) to learn from, such as labels_table. At most
    `sample` distinct URLs of it are fitted, those with the smallest hashes; a
    URL with both labels counts as blocked, null labels don't count.

    A null url, or one without ://, has an empty host and path; such pages are
    scored too. Null ids stay null; repeated rows give repeated rows; an empty
    table gives an empty one; without labelled rows the score is 0.5 (allow),
    and labels of one kind only decide every page. URLs of any length are read
    whole. Rules are a short list that goes into the plan.
    """
    spark = pages.sparkSession
    known = labelled.where("blocked IS NOT NULL").select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("blocked").cast("boolean").alias("blocked"))
    weights, bias = fit(sampled(known, sample))
    model = spark.sparkContext.broadcast((weights.astype(np.float32), bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                z = logits(weights, bias, part.column("host").to_pylist(), part.column("path").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())], [*part.schema.names, "score"])

    scored = url_rules(pages, rules, id_col, url_col).withColumnRenamed("verdict", "given").mapInArrow(run, "page_id long, host string, path string, rule string, given string, score double")
    learned = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("given", learned).alias("verdict"), "score")
