import math
import re
from collections import Counter

from pyspark.sql import functions as F

from assayer.llm import quality
from assayer.llm.quality import accepted, judged, text_stats

from .conftest import LONG, PROSE


def brute_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + s for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for s in range(3)}
    lines, dup = (text or "").split("\n"), 0
    for i, line in enumerate(lines):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_stats(texts):
    odd = [None, "", " \n\t", "a b c a b c", "a a a a", "x\x1cy\x85z\xa0w", "日本 # | <>\n\n日本\n日本", "l\nl\n l\n\n\nl", LONG]
    for text in [*texts.values(), *odd]:
        assert text_stats(text) == brute_stats(text)


def bounds(values, centred):
    """Least and greatest value that stays, by values rounded to bins of a sixteenth."""

    def edges(x):
        shift = max(0, x.bit_length() - 5)
        return (x >> shift) << shift, ((x >> shift) + 1 << shift) - 1

    ordered = [edges(x) for x in sorted(values)]
    at = lambda part: ordered[-(-len(ordered) * part // 4) - 1]
    if centred:
        q1, q3 = at(1)[0], at(3)[1]
        return q1 - quality.FENCE * (q3 - q1), q3 + quality.FENCE * (q3 - q1)
    step = quality.STEP
    upper = [e for e in ordered if e >= at(2)]
    return 0, next((a[1] for a, b in zip(upper, upper[1:]) if a != b and b[0] + step >= quality.VALLEY * (a[1] + step)), math.inf)


def test_thresholds_by_brute_force(documents, texts):
    docs = documents.select("doc_id", "text", "lang", "source")
    names = {r["doc_id"]: (r["lang"], r["source"]) for r in docs.select("doc_id", "lang", "source").collect()}
    stats = {d: dict(zip(quality.STATS, brute_stats(t))) for d, t in texts.items()}
    fine = {d for d, s in stats.items() if s["n_words"] >= 50 and 100 * s["n_repeat_words"] <= 50 * s["n_words"]}

    def metric(d, m):
        numerator, scale, _ = quality.METRICS[m]
        return stats[d][numerator] * scale // stats[d]["n_words"]

    def kept(d):
        if d not in fine:
            return False
        for chosen in (names[d], names[d][:1], ()):
            group = [x for x in fine if names[x][: len(chosen)] == chosen]
            if len(group) >= quality.LEAST_ROWS:
                break
        for m, (_, _, centred) in quality.METRICS.items():
            least, most = bounds([metric(x, m) for x in group], centred)
            if not least <= metric(d, m) <= most:
                return False
        return True

    rows = judged(docs, with_text=False).select("row.doc_id", *quality.STATS, "base_failed", "kept").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert {s: r[s] for s in quality.STATS} == stats[r["doc_id"]]
        assert r["base_failed"] == (r["doc_id"] not in fine) and r["kept"] == kept(r["doc_id"])


def test_clean_documents_stay_and_junk_goes(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = judged(documents, with_text=False).select("row.doc_id", "base_failed", "kept").join(labels, "doc_id").collect()
    fine = [r for r in rows if not r["base_failed"]]
    assert all(r["kept"] == (r["quality"] == 1) for r in fine)


def test_sketches_merge(documents):
    rows = quality.measured(documents, False).withColumns({c: F.col(f"row.{c}") for c in ("lang", "source")})
    whole = {tuple(r[:4]): r[4] for r in quality.sketched(rows).collect()}
    parts = Counter()
    for part in (rows.filter("row.doc_id % 3 = 0"), rows.filter("row.doc_id % 3 <> 0")):
        for r in quality.sketched(part).collect():
            parts[tuple(r[:4])] += r[4]
    assert whole == parts


def test_edge_rows(edge, nothing):
    rows = {(r["doc_id"], r["n_words"]): r for r in judged(edge).select("row.doc_id", *quality.STATS, "base_failed", "kept").collect()}
    assert rows[1, 0]["base_failed"] and not rows[1, 0]["kept"] and rows[None, 0]["base_failed"]
    kept = accepted(edge)
    assert kept.columns == edge.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted([PROSE, PROSE, PROSE, PROSE + " more"])
    assert accepted(nothing).collect() == [] and judged(nothing).collect() == []


def test_bounds_follow_the_group(spark):
    """What is rejected in a source without symbols stays in one where documents have them at every rate; copies of junk do not move a bound."""

    def text(symbols):
        return " ".join([f"word{i}x" for i in range(100 - symbols)] + ["#"] * symbols)

    rows = [("prose", 0)] * 100 + [("prose", 1)] * 3 + [("prose", 40)] * 45 + [("code", k) for k in range(0, 45) for _ in range(3)]
    df = spark.createDataFrame([(i, text(k), "en", s, k) for i, (s, k) in enumerate(rows)], "doc_id int, text string, lang string, source string, k int")
    got = {(r["source"], r["k"]): r["kept"] for r in judged(df).select("row.source", "row.k", "kept").collect()}
    assert got["prose", 0] and got["prose", 1] and not got["prose", 40]
    assert all(got["code", k] for k in range(0, 36))
