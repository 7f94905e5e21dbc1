"""Operators against SQL, brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import numpy as np
import pytest
from compare import difference, duck

from tagloom.llm import (
    bpe, chat, decontaminate, jaccard_join, language_id, pii, quality, registry, sharding,
    token_output, toxicity,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(registry.QUERIES[name](spark, SF), duck(SF), registry.ORACLE[name]) is None


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# 1 n-gram Jaccard join


def brute_links(texts: dict, similarity: float = 0.8) -> dict[int, set[int]]:
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return {
        i: {j for j, b in sets.items() if i != j and a and b and len(a & b) >= similarity * len(a | b)}
        for i, a in sets.items()
    }


def test_join_of_many_near_copies(spark, monkeypatch):
    """Buckets beyond the limit split, and clusters beyond a block are compared in blocks."""
    monkeypatch.setattr(jaccard_join, "LIMIT", 16)
    monkeypatch.setattr(jaccard_join, "BLOCK", 12)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(12)]
    made = []
    for i in range(60):  # near copies of one text
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            words[at] = f"x{i}_{at}"
        made.append(" ".join(words))
    for i in range(60):  # different texts that share a passage
        made.append(" ".join([f"y{i}_{k}" for k in range(int(rng.integers(3, 60)))] + passage))
    texts = dict(enumerate(made + made[:20]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    links = brute_links(texts)
    got = {r["doc_id"]: r for r in jaccard_join.join(df).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(x) for i, x in links.items()}
    for i, near in links.items():
        assert all(got[j]["class_id"] == got[i]["class_id"] for j in near)
        assert got[i]["class_id"] <= i


@pytest.mark.parametrize("levels", [1, 6])
def test_families_that_share_a_passage(spark, monkeypatch, levels):
    """Two families of near copies and many other texts meet in the buckets of one passage."""
    monkeypatch.setattr(jaccard_join, "LIMIT", 16)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 2000)
    monkeypatch.setattr(jaccard_join, "LEADERS", 3)
    monkeypatch.setattr(jaccard_join, "LEVELS", levels)
    rng = np.random.default_rng(11)
    passage = [f"p{i}" for i in range(40)]
    made = []
    for family in "ab":
        base = [f"{family}{i}" for i in range(50)]
        for i in range(70):
            words = list(base)
            for at in rng.choice(50, rng.integers(0, 3), replace=False):
                words[at] = f"{family}x{i}_{at}"
            made.append(" ".join(words[:25] + passage + words[25:]))
    for i in range(60):
        made.append(" ".join([f"y{i}_{k}" for k in range(int(rng.integers(2, 90)))] + passage))
    texts = dict(enumerate(made))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    links = brute_links(texts)
    got = {r["doc_id"]: r for r in jaccard_join.join(df).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(x) for i, x in links.items()}


def test_recall_at_the_threshold(spark):
    """Pairs whose similarity is between 0.8 and 0.82, each of texts of their own."""
    rng = np.random.default_rng(9)
    texts, wanted = {}, 0
    for i in range(150):
        n = int(rng.integers(60, 400))
        words = [f"t{i}_{k}" for k in range(n)]
        other = list(words)
        for at in rng.permutation(n).tolist():
            before, other[at] = other[at], f"c{i}_{at}"
            a, b = ({tuple(x[k : k + 5]) for k in range(n - 4)} for x in (words, other))
            if len(a & b) < 0.8 * len(a | b):
                other[at] = before
        a, b = ({tuple(x[k : k + 5]) for k in range(n - 4)} for x in (words, other))
        assert 0.8 <= len(a & b) / len(a | b) < 0.86
        texts |= {2 * i: " ".join(words), 2 * i + 1: " ".join(other)}
        wanted += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = jaccard_join.join(df).filter("n_links = 1").count()
    assert found >= 0.999 * 2 * wanted


def test_runs_reach_the_recall():
    assert jaccard_join.runs_for(1 - 1e-6) > jaccard_join.runs_for(0.9) >= 1


# 2 quality rules


def test_collision_safe_repeats(spark):
    """The fast path and the sorting of windows by value agree."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 6, int(rng.integers(0, 40))))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = quality._words(F.col("text"))
    found = df.select(
        "text", quality._repeats(words).alias("fast"),
        F.when(F.size(words) >= 3, quality._by_value(words)).otherwise(0).alias("slow"),
    ).collect()
    for r in found:
        w = r["text"].split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        want = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        assert r["fast"] == r["slow"] == len(want)


def test_ablations_match_the_ledger(docs):
    ledger = quality.ledger(docs).cache()
    rows = ledger.collect()
    for r in quality.ablations(ledger, quality.STRICT).collect():
        bits = [x["fail_bits"] & quality.STRICT.mask for x in rows]
        bit = quality.BIT[r["rule"]]
        assert r["n_failed"] == sum(bool(b & bit) for b in bits)
        assert r["n_only"] == sum(b == bit for b in bits)
        assert r["n_kept_without"] == sum(not b & ~bit for b in bits)


# 3 token output


def test_slots_are_a_permutation():
    for n in (1, 2, 3, 17, 1000, 4099):
        slots = token_output.permute(np.arange(n), n)
        assert sorted(slots.tolist()) == list(range(n))
    assert token_output.permute(np.arange(100), 100, key=1).tolist() != slots[:100].tolist()


def test_shards_round_trip(docs, texts, tmp_path):
    ordered = token_output.in_training_order(docs, length=64, per_shard=200)
    rows = ordered.collect()
    made = token_output.write_shards(ordered, f"file://{tmp_path}").collect()
    again = token_output.write_shards(ordered, f"file://{tmp_path}").collect()
    assert sorted(made) == sorted(again) and sum(r["n_records"] for r in made) == len(rows)
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    paths = {r["shard"]: r["path"] for r in made}
    ids: dict[int, dict] = {}
    for r in rows:
        record = token_output.read_records(paths[r["shard"]], r["offset"] // 128, 1, 64)[0]
        assert record.tobytes() == r["record"]
        ids.setdefault(r["doc_id"], {})[r["part"]] = record[: r["n_tokens"]]
    model = token_output.load(token_output.default_path())
    for i, parts in ids.items():
        got = np.concatenate([parts[k] for k in sorted(parts)]).tolist()
        assert got == [*model.ordinary(texts[i]), model.end]


# 4 toxicity, 5 language


def test_toxicity_finds_changed_insults():
    rng = np.random.default_rng(3)
    syllables = ["the", "on", "er", "tion", "ble", "sh", "re", "an", "ing", "wh", "ea", "st"]

    def text(bad: list[str]) -> str:
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(60)]
        for b in bad:
            words[rng.integers(0, 60)] = b
        return " ".join(words)

    insults = ["idiot", "moron", "scum", "loser"]
    toxic = [text(list(rng.choice(insults, 3))) for _ in range(120)]
    clean = [text([]) for _ in range(200)]
    model = toxicity.fit(toxic, clean)
    weights = model.weights()
    score = lambda t: model.score(t, weights)
    assert np.mean([score(text([x])) >= 0.7 for x in insults * 10]) > 0.9
    assert np.mean([score(text([])) >= 0.7 for _ in range(60)]) < 0.05
    changed = [score(text([x])) for x in ("id-iot", "mor.on", "lo-ser")]
    assert np.mean(changed) > np.mean([score(text([])) for _ in range(30)]) + 0.2


def test_toxicity_in_every_language(spark):
    """Held-out rows of the largest table: most toxic ones are found in each language, few clean ones are hit."""
    from pyspark.sql import functions as F

    big = f"{SF.rsplit('/', 1)[0]}/sf0.1"
    docs = spark.read.parquet(f"{big}/documents.parquet")
    marked = spark.read.parquet(f"{big}/labels.parquet").filter("toxic IS NOT NULL")
    found = registry.QUERIES["op4_toxicity"](spark, big).filter("held_out")
    rows = found.join(marked, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").groupBy("lang").agg(
        F.count_if(F.expr("toxic = 1")).alias("toxic"), F.count_if(F.expr("toxic = 1 AND predicted = 1")).alias("caught"),
        F.count_if(F.expr("toxic = 0")).alias("clean"), F.count_if(F.expr("toxic = 0 AND predicted = 1")).alias("wrong"),
    ).collect()
    assert len(rows) == 4
    for r in rows:
        assert r["caught"] >= 0.65 * r["toxic"], r
    assert sum(r["caught"] for r in rows) >= 0.8 * sum(r["toxic"] for r in rows)
    assert sum(r["wrong"] for r in rows) <= 0.015 * sum(r["clean"] for r in rows)


def test_worst_windows_by_brute_force(monkeypatch):
    """Peaks of a text are the greedy choice among all its windows, also where it is read in parts."""
    rng = np.random.default_rng(5)
    weights = np.zeros(toxicity.CODES + 1, np.float32)
    picked = rng.integers(0, toxicity.CODES, 400_000)
    weights[picked] = rng.normal(size=len(picked)).astype(np.float32)
    text = "".join(rng.choice(list("abcdé \n!Z"), 700))
    want = toxicity.worst(text, weights)
    total = [toxicity.sums(toxicity.letters(text[i : i + toxicity.REACH]), weights)[0] for i in range(len(text))]
    left, plain = set(range(len(text))), []
    while len(plain) < toxicity.PEAKS:
        at = max(left, key=lambda i: (total[i], -i))
        plain.append(total[at])
        left = {i for i in left if abs(i - at) >= toxicity.REACH and abs(total[i] - total[at]) >= 1e-5}
    assert np.allclose([value for value, _ in want], plain, atol=1e-4)
    monkeypatch.setattr(toxicity, "PART", 90)
    assert np.allclose([value for value, _ in toxicity.worst(text, weights)][:1], plain[:1], atol=1e-4)
    assert toxicity.worst(None, weights) == toxicity.worst("", weights) == []


def test_window_sums_are_kernel_values():
    """The pass over a whole text gives what explicit kernel values with landmarks give."""
    landmarks, values = ["idiot idiot ", "the trash is"], np.array([0.7, -0.2])
    weights = toxicity._fold(landmarks, values)
    window = "an idi-ot the"[: toxicity.WINDOW + toxicity.SPAN]
    direct = toxicity._kernel([window], landmarks)[0] @ values
    assert abs(toxicity.sums(toxicity.letters(window), weights)[0] - direct) < 1e-4


def test_language_held_out(spark, docs):
    found = registry.QUERIES["op5_language_id"](spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    own = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in found)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in own]) > 0.9


def test_language_model_is_a_distribution(docs):
    import pyarrow as pa

    counts = language_id.ngram_counts(docs.filter("lang IS NOT NULL")).toArrow()
    model = language_id.build(pa.table(counts))
    history = int(model.keys[len(model.keys) // 2]) >> language_id.BITS
    key = np.array([history << language_id.BITS | s for s in range(language_id.SYMBOLS)], np.int32)
    assert np.allclose(np.exp(-model.costs(key)).sum(0), 1, atol=1e-4)


# 6 sharding


def test_shards_are_even_and_keep_copies_together(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 4}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.assign(df, shards=8).collect()
    by_shard: dict[int, list] = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
        assert r["size"] == len(rows[r["doc_id"]][1]) + 1
    sizes = [len(x) for x in by_shard.values()]
    assert sum(sizes) == 1200 and max(sizes) - min(sizes) <= 1
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by_shard.values())
    groups: dict[str, list[int]] = {}
    for r in got:
        groups.setdefault(rows[r["doc_id"]][1], []).append(r["shard"])
    whole = [len(set(x)) == 1 for t, x in groups.items() if t != "hot" and len(x) > 1]
    assert np.mean(whole) > 0.8


# 7 decontamination


def test_blocks_of_the_benchmark_give_the_same(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = decontaminate.contamination(docs, bench).collect()
    many = decontaminate.contamination(docs, bench, block_bytes=1500).collect()
    key = lambda r: (r["doc_id"], r["n_words"], tuple(r["items"]), r["n_hit"])
    assert sorted(map(key, one)) == sorted(map(key, many)) and any(r["n_hit"] for r in one)
    clean = {r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()}
    assert clean == {r["doc_id"] for r in one if not r["n_hit"]}


def test_longest_matches(spark):
    words = [f"w{i}" for i in range(30)]
    docs = [(1, " ".join(["a", *words[2:20], "b"])), (2, " ".join(words[5:17]))]
    found = decontaminate.longest_matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(9, " ".join(words))], "item_id long, text string"),
    ).collect()
    got = {r["position"]: (r["n_words"], r["doc_id"], r["doc_position"]) for r in found}
    assert got[2] == (18, 1, 1) and got[5] == (15, 1, 4) and min(got) == 2
    assert got[10] == (10, 1, 9) and max(got) == 10


# 8 personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_spans(text: str) -> list[tuple]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "email" or (
                kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
            ) or (kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)) or (
                kind == "phone" and 8 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark, texts):
    rng = np.random.default_rng(4)
    letters = list("0123456789" * 2 + "  --..++@@()ab_%é\U0001f642")
    made = ["".join(rng.choice(letters, int(rng.integers(0, 120)))) for _ in range(1500)]
    made += list(texts.values()) + ["4111 1111 1111 1111 ok", "mail a.b@c.d_e@f.g x"]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    for r in pii.annotate(df).collect():
        base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
        assert base == brute_spans(made[r["doc_id"]])
        assert set(base) <= {(s["kind"], s["start"], s["end"]) for s in r["spans"]}


def test_redacted_texts(spark):
    rows = [(1, "a x@y.zz b 10.0.0.1"), (2, "+1 (212) 555-0100x@y.zz tail"), (3, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert got[1] == "a <EMAIL> b <IP>" and got[3] == "nothing"
    assert "@" not in got[2] and "555" not in got[2] and got[2].endswith(" tail")


def test_reliabilities_favour_agreement():
    real = pii.reliabilities({("ip", "yyy-y"): 50, ("ip", "-nn-n"): 40, ("ip", "yny-n"): 5})
    assert real["ip", "yyy-y"] > 0.9 and real["ip", "-nn-n"] < 0.1


# 9 BPE


def test_bpe_equals_the_library(docs, texts):
    from tokenizers import Tokenizer

    model, ours = Tokenizer.from_file(bpe.default_path()), bpe.load(bpe.default_path())
    rng = np.random.default_rng(6)
    letters = [*" \n\t  aabés19²½.,!$  \x1c\x1d\x85　漢字\U0001f642́\x00<|>", "<|endoftext|>", "'ll", "\n\n"]
    made = ["".join(rng.choice(letters, int(rng.integers(0, 25)))) for _ in range(3000)]
    for text in made + ["ab" * 5000]:
        ids = model.encode(text, add_special_tokens=False).ids
        assert list(ours.encode(text)) == ids
        assert ours.decode(ids) == model.decode(ids, skip_special_tokens=False)
    for r in bpe.round_trip(docs).collect():
        ids = model.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs)).collect()
    assert {r["doc_id"]: r["text"] for r in back} == texts


# 10 tool calls


def test_tool_calls_from_json(spark):
    def call(i, name, arguments, after=()):
        return {"id": i, "name": name, "arguments": arguments, "after": list(after)}

    calls = [
        call("b", "ask", '{"text": "hi there you", "n_words": 3}'),
        call("a", "ask", '{"text": "", "n_words": "3", "more": {"z": 1, "b": [2, null]}}', ["b"]),
    ]
    loop = [call("x", "ask", "[]", ["y"]), call("y", "none", None, ["x"])]
    rows = [
        ("1", 0, "assistant", json.dumps({"tool_calls": calls})),
        ("1", 1, "tool", json.dumps({"tool_call_id": "b", "content": "fine"})),
        ("1", 2, "tool", json.dumps({"tool_call_id": "b", "content": "again"})),
        ("2", 0, "assistant", json.dumps({"tool_calls": loop})),
        ("2", 1, "assistant", "{broken"),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {r["call_id"]: r for r in chat.link(*chat.from_json(df)).collect()}
    assert got["a"]["level"] == 1 and got["b"]["level"] == 0 and got["x"]["level"] == -1
    assert got["b"]["errors"] == "identifier: repeated by results"
    assert json.loads(got["b"]["json"])["content"] == "fine"
    for text in ("text: below 1", "n_words: not of type integer", "unexpected argument", "result: missing"):
        assert text in got["a"]["errors"]
    assert '"arguments":{"more":{"b":[2,null],"z":1},"n_words":"3","text":""}' in got["a"]["json"]
    assert "arguments: not an object" in got["x"]["errors"] and "name: unknown tool" in got["y"]["errors"]


def test_pipeline_against_brute_force(spark, docs, texts):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in rows}
    assert rows[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    links = brute_links(texts)
    assert not any(links[i] & ids for i in ids)
    hit = {
        r["doc_id"] for r in registry.QUERIES["op7_decontaminate"](spark, SF).filter("contaminated").collect()
    }
    assert not ids & hit
    lost = set(texts) - ids - hit
    assert all(any(links[i]) or not re.search("[a-z]{4}", texts[i]) for i in lost)
