"""Operators on pairs and groups, the pipeline, and odd tables."""

import itertools
import re

import public_tokenizers
import pytest
from planted import prose
from pyspark.sql import functions as F

import corpus_pipeline
from folioscan.llm import components, decontam, licences, line_dedup, ngram_join, packing, quality_model, quality_rules, queries, secrets, sharding, token_counts


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


@pytest.mark.parametrize("force", [False, True])
def test_ngram_join(docs, corpus, force, monkeypatch):
    monkeypatch.setattr(ngram_join, "plan", lambda band, n: force)
    monkeypatch.setattr(ngram_join, "COMMON", 20)  # the planted group of 90 is common
    sets = {i: shingle_set(t) for i, t, _ in corpus}
    groups = Groups()
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            groups.join(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs).collect()}
    assert got == {i: (len(s), groups.find(i)) for i, s in sets.items()}
    stay = sorted(r.doc_id for r in ngram_join.one_of_each(docs).collect())
    assert stay == sorted(i for i, s in sets.items() if not s or groups.find(i) == i)


def test_signatures_of_linked_sets_meet():
    """Any two sets at the very limit share as many signatures as the filter asks for, whatever their sizes."""
    import numpy as np

    r = np.random.default_rng(4)
    for deletions in (False, True):
        for n in [*range(1, 40), 63, 64, 65, 85, 86, 200, 255, 256, 341, 342, 700]:
            for m in {n, max(n, 4 * n // 3), n + (n * 4 // 3 - n) // 2}:
                # m elements, n of them kept and some replaced, as far as the limit allows
                for swap in range(n // 7 + 1, -1, -1):
                    both = n - swap
                    if 100 * both >= 75 * (n + m - both):
                        break
                pool = r.integers(0, 2**63, size=n + m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                x, y = np.unique(pool[:n]), np.unique(np.concatenate([pool[:both], pool[n : n + m - both]]))
                if 100 * both < 75 * (n + m - both):
                    continue
                a, b = (ngram_join.signatures(s, [deletions] * 32) for s in (x, y))
                shared = len({int(v) for _, _, f in a for v in f} & {int(v) for _, _, f in b for v in f})
                least = min(min(k for _, k, _ in a), min(k for _, k, _ in b))
                assert shared >= least, (deletions, n, m, both)


def test_components(spark):
    import random

    r = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)] + [(7, 7), (2000, 2000)]
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    got = {x.node: x.label for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.find(x) for e in edges for x in e}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def coded_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words_of(line):
    return [w for w in re.split(r"[^\w]|_", line.lower()) if w]


def simhashes(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "line string").distinct()
    hashes = F.transform(line_dedup.words_of(F.col("line")), lambda w: F.xxhash64(w).bitwiseAND(F.lit(2**63 - 1)))
    rows = df.select("line", hashes.alias("h")).select("line", "h", line_dedup.simhash(F.col("h")).alias("s")).collect()
    for r in rows:
        assert r.s == sum(1 << b for b in range(63) if 2 * sum(h >> b & 1 for h in r.h) > len(r.h))
    return {r.line: r.s for r in rows}


def test_line_dedup(spark, docs, corpus):
    """The same lines go as by brute force over all pairs within the radius."""
    occurrences = [((i, None, pos), words_of(x), x) for i, t, _ in corpus for pos, x in enumerate((t or "").split("\n")) if len(words_of(x)) >= 10]
    sims = simhashes(spark, [x for _, _, x in occurrences])
    distinct = {}
    for at, w, x in occurrences:
        distinct.setdefault(tuple(w), (sims[x], []))[1].append(at)
    groups = Groups()
    for (a, (s, _)), (b, (t, _)) in itertools.combinations(distinct.items(), 2):
        groups.find(a), groups.find(b)
        longer = max(len(a), len(b))
        if (s ^ t).bit_count() <= 3 and coded_distance(a, b) <= 0.25 * longer:
            groups.join(a, b)
    held = {}
    for w, (_, ats) in distinct.items():
        held.setdefault(groups.find(w), []).extend(ats)
    gone = {}
    for ats in held.values():
        first = min(ats, key=lambda x: (x[0], x[2]))
        for i, _, pos in ats:
            if (i, pos) != (first[0], first[2]):
                gone.setdefault(i, set()).add(pos)
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert {i: {int(x) for x in r.removed.split(",")} for i, r in got.items() if r.removed} == gone
    assert all(r.n_lines == (t or "").count("\n") + 1 for i, t, _ in corpus for r in [got[i]])
    clean = {r.doc_id: r.text for r in line_dedup.without_repeats(docs).collect()}
    for i, t, _ in corpus:
        assert clean[i] == (t if i not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]))


def test_long_lines_by_runs(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LONG", 50)
    a, b, c = prose(1, 200), prose(1, 200).replace("ba", "be", 3), prose(2, 200)
    docs = spark.createDataFrame([(1, a), (2, a + " more"), (3, c)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(docs).collect()}
    assert b and got == {1: 0, 2: 1, 3: 0}


OPERATORS = {
    "classify": lambda d, b, n: quality_model.classify(d),
    "ngram_join": lambda d, b, n: ngram_join.ngram_join(d),
    "quality_rules": lambda d, b, n: quality_rules.quality_rules(d, n),
    "line_dedup": lambda d, b, n: line_dedup.line_dedup(d),
    "shards": lambda d, b, n: sharding.shards(d, 100),
    "pack_documents": lambda d, b, n: packing.pack_documents(d, public_tokenizers.path("byte_bpe_50k.json")),
    "licence_scan": lambda d, b, n: licences.licence_scan(d),
    "secret_scan": lambda d, b, n: secrets.secret_scan(d),
    "overlaps": lambda d, b, n: decontam.overlaps(d, b),
    "token_counts": lambda d, b, n: token_counts.token_counts(d, public_tokenizers.path("word_bpe_49k.json")),
    "keep_good": lambda d, b, n: quality_rules.keep_good(d, n),
    "without_repeats": lambda d, b, n: line_dedup.without_repeats(d),
    "one_of_each": lambda d, b, n: ngram_join.one_of_each(d),
    "decontaminate": lambda d, b, n: decontam.decontaminate(d, b),
}
BY_ROW = ("classify", "ngram_join", "quality_rules", "line_dedup", "shards", "secret_scan", "token_counts", "without_repeats")
FILTERS = ("keep_good", "without_repeats", "one_of_each", "decontaminate")


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, odd, spark):
    bench = spark.createDataFrame([(1, prose(2, 40), 5), (None, None, 6)], "item_id long, text string, doc_id long")
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 1), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = OPERATORS[name](odd, bench, labels)
    rows = out.collect()
    if name in BY_ROW:
        assert len(rows) == odd.count()
    if name in FILTERS:
        assert out.columns == odd.columns and out.dtypes == odd.dtypes
    if name == "one_of_each":
        # one of the rows with the same text, the other text of id 1, the words of 3 and 5, and three without words
        assert sorted((r.doc_id or 0) for r in rows if (r.text or "").strip()) == [0, 1, 3, 5]
    if name == "overlaps":
        assert [(r.doc_id, r.item_id) for r in rows] == [(1, 1)]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, odd, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert OPERATORS[name](odd.limit(0), bench, labels).count() == 0


def test_pipeline(spark, corpus, tmp_path):
    path = str(tmp_path / "in")
    rows = [(i, t, g or "en", "s", len(t or "")) for i, t, g in corpus]
    bench = [(1, prose(12345, 40))]
    rows.append((9000, prose(1, 60) + " " + bench[0][1] + " " + prose(4, 60), "en", "s", 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i, *_ in rows[:40]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.materialise(stage(spark, seen[-1], path), "test"))
    assert all(d.columns == docs.columns for d in seen[:-1])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert ids[1] == {r.doc_id for r in quality_rules.quality_rules(docs, spark.read.parquet(f"{path}/labels.parquet")).where("kept").collect()}
    assert ids[2] == ids[1]
    first = {r.doc_id: r.component_id for r in ngram_join.ngram_join(seen[2]).collect()}
    empty = {r.doc_id for r in seen[2].collect() if not r.text.strip()}
    assert ids[3] == {i for i in ids[2] if first[i] == i or i in empty}
    assert ids[4] == ids[3] - {9000} and ids[5] == ids[4]
    tokens = seen[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert tokens.where("n <> m").isEmpty()
    assert corpus_pipeline.run(spark, path).count() == seen[5].count()


def test_registry():
    numbers = sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]


@pytest.mark.parametrize("others", [33, 60, 1000])
@pytest.mark.parametrize("blocks", [None, 12])
def test_common_runs_lose_no_pair(spark, others, blocks):
    """Lines of twelve words, three of them substituted, whose one common run stands in many other lines too."""
    rows = []
    for k in range(5):
        w = [f"{k}word{chr(97 + i)}x" for i in range(12)]
        far = [x if i in (0, 1, 3, 4, 5, 7, 8, 10, 11) else f"{k}other{i}y" for i, x in enumerate(w)]
        rows += [(" ".join(w),), (" ".join(far),)]
        # runs of three that both have: words 3 to 5 alone
        rows += [(" ".join([f"{k}z{j}a{i}" for i in range(4)] + w[3:6] + [f"{k}z{j}b{i}" for i in range(5)]),) for j in range(others)]
    docs = spark.createDataFrame([(i, t) for i, (t,) in enumerate(rows)], "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.line_dedup(docs, radius=None, blocks=blocks).where("n_removed > 0").collect()}
    assert gone == {k * (others + 2) + 1 for k in range(5)}
