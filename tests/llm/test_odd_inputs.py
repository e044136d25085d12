"""One contract for odd inputs, over all operators and pipeline stages: nothing fails, no row is lost, ids stay."""

import hashlib
import random

import pytest

import corpus_pipeline as P
from toolloom.llm import chat, decontaminate, langid, line_dedup, packing, quality, simhash, substring, suffix_array, token_files

SF = "/root/testdata/sf0.001"
NAMES = ["gone", "kept", "parts", "th", "n_lines", "n_removed", "score", "lang_pred", "row", "doc", "home", "bucket", "fp", "head", "head_th", "component", "k", "v"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *NAMES) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(80))
    long = " ".join(word() for _ in range(200_000))  # more than a megabyte
    same = f"{passage}\nanother line {word()}"
    return [(None, passage), (2, passage), (3, passage), (3, passage), (4, None), (5, ""), (6, " \n "), (7, same), (7, f"{word()} {passage} x"), (8, long), (9, "z" * 300_000), (None, None), (10, "one\r\none")]


def score(df):
    return quality.score(df, None)


OPERATORS = {
    "op1": lambda df: substring.remove_repeats(df), "op2": lambda df: decontaminate.contamination(df, df.sparkSession.read.parquet(f"{SF}/benchmark.parquet")),
    "op3": lambda df: suffix_array.remove_repeats(df), "op5": lambda df: packing.pack(df).where("piece = 0"), "op6": lambda df: langid.identify(df.select("doc_id", "text"), None),
    "op8": simhash.near_components, "op9": score, "op10": line_dedup.dedup_lines,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(spark, rows, name):
    run = OPERATORS[name]
    out = run(docs(spark, rows)).toPandas()
    ids = sorted(-1 if x != x or x is None else int(x) for x in out["doc_id"])
    assert ids == sorted(-1 if i is None else i for i, _ in rows)
    assert run(docs(spark, [])).count() == 0
    by = lambda i: out[out["doc_id"].isna()] if i is None else out[out["doc_id"] == i]
    if name == "op1":
        assert by(2)["n_removed"].tolist() == [0] and by(3)["n_removed"].tolist() == [80, 80] and sorted(by(None)["n_removed"]) == [0, 80] and by(9)["n_words"].tolist() == [1]
    if name == "op3":
        assert all((by(i)["n_removed"] == len(rows[1][1])).all() for i in (2, 3)) and by(9)["n_removed"].tolist() == [300_000]
    if name == "op8":
        assert set(by(3)["component_id"]) == {2} and set(by(4)["component_id"]) == {4} and set(by(5)["component_id"]) == {4}
    if name == "op10":
        assert by(2)["n_removed"].tolist() == [0] and by(3)["n_removed"].tolist() == [1, 1] and sorted(by(None)["n_removed"]) == [0, 1] and sorted(by(7)["n_removed"])[-1] == 1
        assert [c for c in NAMES if c not in out.columns] == [] and set(out["gone"]) == {"gone"} and list(out.columns).count("kept") == 1
        assert by(8)["kept"].iloc[0] == rows[9][1]


def test_token_files(spark, rows, tmp_path):
    written = token_files.write_files(docs(spark, rows), f"file://{tmp_path}/out").toPandas()
    out = token_files.digest(spark, f"file://{tmp_path}/out", spark.createDataFrame(written)).toPandas().sort_values("start")
    assert len(out) == len(rows) and out["doc_id"].isna().tolist()[-2:] == [True, True] and out["start"].tolist() == (out["n_tokens"].cumsum() - out["n_tokens"]).tolist()
    none = token_files.write_files(docs(spark, []), f"file://{tmp_path}/none").toPandas()
    assert len(none) == 0


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, seq string"
    said = spark.createDataFrame([(1, 0, "user", "x" * 1_000_000, "s"), (1, 1, "assistant", None, "s"), (2, 0, None, "", "s"), (None, 0, "user", "a", "s")], schema)
    out = chat.read_back(chat.format_turns(said)).toPandas()
    assert sorted(out["conv_id"].dropna().astype(int)) == [1, 2] and out.set_index("conv_id").loc[1, "turns_sha256"] == hashlib.sha256(("user\n" + "x" * 1_000_000 + "\nassistant\n\n").encode()).hexdigest()
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], schema))).count() == 0


@pytest.mark.parametrize("stage", [s for s in P.STAGES if s[0] != "packed"], ids=lambda s: s[0])
def test_stages(spark, rows, stage):
    df = docs(spark, rows)
    out = stage[1](spark, df, SF)
    assert out.columns == df.columns
    kept = out.toPandas()
    assert set(kept["gone"]) <= {"gone"} and (kept["text"].dropna().str.len() == kept.loc[kept["text"].notna(), "n_chars"]).all()
    if stage[0] == "language":
        assert not kept["text"].isna().any() and 8 in set(kept["doc_id"].dropna())
    if stage[0] == "lines":
        assert 2 in set(kept["doc_id"].dropna()) and 3 not in set(kept["doc_id"].dropna()) and 4 in set(kept["doc_id"].dropna())
    if stage[0] == "near_duplicates":
        ids = set(kept["doc_id"].dropna())
        assert {2, 4, 8, 9, 10} <= ids and not {3, 5, 6} & ids
    assert stage[1](spark, docs(spark, []), SF).count() == 0


def test_rejected_and_kept_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    out = P.language(spark, df, SF)
    assert out.where("lang is not null").count() == df.where("lang is not null and text rlike '[a-zA-Z]'").count()
    net = langid.train(df)
    assert langid.keep_known(docs(spark, [(1, "12 34"), (2, None), (3, "the"), (4, "##")]), net, 0.0).count() == 1


def test_lines_stage_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    size = line_dedup.SHINGLE
    rows = sorted((r["doc_id"], k, x.strip(" ").lower()) for r in df.collect() for k, x in enumerate((r["text"] or "").split("\n")) if x.strip(" \t\n\r\x0b\x0c"))
    sets = {x: frozenset(x[k : k + size] for k in range(max(1, len(x) - size + 1))) for x in {r[2] for r in rows}}
    texts, part, links = sorted(sets, key=lambda x: len(sets[x])), {x: x for x in sets}, 0

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, x in enumerate(texts):
        for y in texts[a + 1 :]:
            if len(sets[y]) * 8 > len(sets[x]) * 10:
                break
            c = len(sets[x] & sets[y])
            if 10 * c >= 8 * (len(sets[x]) + len(sets[y]) - c):
                links += 1
                part[find(x)] = find(y)
    seen, gone = set(), {}
    for i, _, x in rows:
        if (c := find(x)) in seen:
            gone[i] = gone.get(i, 0) + 1
        seen.add(c)
    out = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(df).collect()}
    assert {i: n for i, n in out.items() if n} == gone and links > 0
