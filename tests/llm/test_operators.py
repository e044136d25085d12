"""Brute force, round trips and odd inputs for the training-data operators."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F
from toolloom.llm import chat, common, decontaminate, langid, line_dedup, packing, quality, simhash, substring, suffix_array, token_files, tokens, words

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, home int, bucket int, label string"


def frame(spark, texts, ids=None):
    """Texts with clashing further columns."""
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, None, "s", None, 1, 2, "x") for i, t in zip(ids, texts)], DOCS)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa,", "ß.", "x-y", "#%", "日本語"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(60)
    out = [None, "", " \n\t ", "one", text(12), text(13), passage, f"{text(30)} {passage} {text(5)}", f"{passage} {text(40)}\n{passage}", text(3000), "a b " * 400, text(50), "aaaa" * 200]
    return [*out, out[11], out[6]]


def test_substring(spark, odd):
    ids = [*range(len(odd)), 6]
    texts = [*odd, odd[6]]
    rows = substring.remove_repeats(frame(spark, texts, ids)).toPandas()
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    least = {}
    for i, w in zip(ids, words):
        for k in range(len(w) - 12):
            least[tuple(w[k : k + 13])] = min(i, least.get(tuple(w[k : k + 13]), i))
    want = []
    for i, w in zip(ids, words):
        gone = {k + j for k in range(len(w) - 12) if least[tuple(w[k : k + 13])] < i for j in range(13)}
        want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    assert sorted(rows[["doc_id", "n_words", "n_removed", "kept_sha256"]].itertuples(index=False, name=None)) == sorted(want)


def test_suffix_array_dedup(spark, odd):
    rows = suffix_array.remove_repeats(frame(spark, odd)).toPandas().set_index("doc_id")
    texts = [(t or "").encode() for t in odd]
    count = Counter(t[k : k + 200] for t in texts for k in range(len(t) - 199))
    for i, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if count[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        assert tuple(rows.loc[i, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]]) == (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i


def test_suffix_array_and_kasai():
    rng = np.random.default_rng(1)
    s = rng.integers(97, 100, 600).astype(np.uint8)
    s[300:550] = s[20:270]
    raw = s.tobytes()
    order = suffix_array.suffix_array(s)
    assert [raw[i : i + 200] for i in order] == sorted(raw[i : i + 200] for i in range(len(raw)))
    common = suffix_array.kasai(raw, order)
    for a, b, c in zip(order, order[1:], common[1:]):
        n = next((k for k in range(200) if raw[a + k : a + k + 1] != raw[b + k : b + k + 1] or a + k >= len(raw) or b + k >= len(raw)), 200)
        assert c == n or (n < 24 and c == 0)


def test_decontamination(spark, odd):
    items = [(1, odd[6]), (2, " ".join((odd[6] or "").split()[20:40])), (3, "one"), (4, None), (5, ""), (6, "W7 w8"), (7, odd[9][:2000])]
    rows = decontaminate.contamination(frame(spark, odd), spark.createDataFrame(items, "item_id long, text string")).toPandas().set_index("doc_id")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    windows = {}
    for i, t in items:
        w = pattern.findall(low(t))
        for k in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + min(13, len(w))]), set()).add(i)
    for i, t in enumerate(odd):
        w, hit, found = pattern.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit |= set(range(k, k + n))
        assert tuple(rows.loc[i]) == (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)), i


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer

    texts = ["", "Hello, World! it's <|endoftext|> x<|startoftext|>.", "Éa é é ǅ İstanbul ΣΑΣ", "a b c\u0085d", "1234 12a a12 ...,. ''s 's don't", "日本語 テスト", "x" * 300, "́a ab́,"]
    direct = Tokenizer.from_file(tokens.vocabulary())
    ids, first = tokens.encoder().encode([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == [*direct.encode(t, add_special_tokens=False).ids, 1], t


def test_token_files(spark, odd, tmp_path):
    v = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    assert token_files.decode(*token_files.encode(v), len(v)).tolist() == v.tolist()
    path = f"file://{tmp_path}/out"
    written = token_files.write_files(frame(spark, odd, range(100, 100 + len(odd))), path).toPandas()
    rows = token_files.digest(spark, path, spark.createDataFrame(written)).toPandas().sort_values("doc_id")
    ids, first = tokens.encoder().encode([(t or "").encode() for t in odd])
    assert rows["start"].tolist() == first[:-1].tolist() and rows["n_tokens"].tolist() == np.diff(first).tolist()
    assert rows["ids_crc32"].tolist() == [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(first, first[1:])]


def test_packing(spark, odd):
    rows = packing.pack(frame(spark, odd + ["w1 " * 3000] * 3), 512).toPandas()
    own = rows.sort_values(["sequence_id", "offset"])
    assert (own["length"].groupby(own["sequence_id"]).cumsum() - own["length"] == own["offset"]).all()
    assert own.groupby("sequence_id")["length"].sum().max() <= 512
    assert rows.groupby("doc_id")["length"].sum().gt(0).sum() == len(odd) + 3
    assert rows["sequence_id"].nunique() <= 1.1 * rows["length"].sum() / 512 + 1


def test_packing_plan_is_near_the_bound():
    rng = np.random.default_rng(5)
    count = np.bincount(np.minimum(rng.lognormal(6, 1, 20000).astype(int) + 1, 4096), minlength=4097)
    _, n = packing.plan(count)
    assert n <= 1.01 * (count * np.arange(4097)).sum() / 4096 + 1


@pytest.mark.parametrize("lengths", [[1300, 1400, 900, 2100, 700], list(range(100, 4097, 7)), [4096, 1, 2]])
def test_packing_plan_places_all_and_keeps_its_bound(lengths):
    rng = np.random.default_rng(6)
    count = np.bincount(rng.choice(lengths, 3000), minlength=4097)
    rows, n = packing.plan(count, rounds=6)
    placed = rows.assign(k=rows["rank_to"] - rows["rank_from"]).groupby("length")["k"].sum()
    assert placed.to_dict() == {l: int(c) for l, c in enumerate(count) if c}
    whole = np.zeros(n, np.int64)
    for r in rows.itertuples():
        at = slice(r.first_sequence, r.first_sequence + r.rank_to - r.rank_from)
        assert (whole[at] == r.offset).all()
        whole[at] += r.length
    assert whole.max() <= 4096 and whole.min() > 0 and rows.attrs["bound"] <= n + 1e-6
    plain = packing.finish(count.copy(), np.zeros(4097, np.int64), [], 0, 4096)
    assert n <= 1.02 * plain and rows.attrs["priced"] > 0


def test_fillings_against_brute_force():
    rng = np.random.default_rng(8)
    weight = np.where(rng.random(41) < 0.4, rng.random(41), 0.0)
    weight[0] = 0
    best, first = packing.fillings(weight, 40)
    want = [0.0] * 41
    for c in range(1, 41):
        want[c] = max([want[c - 1], *(weight[l] + want[c - l] for l in range(1, c + 1) if weight[l])])
    assert np.allclose(best, want)
    for c in range(41):
        own = packing.filling(first, c)
        assert sum(own) <= c and np.isclose(sum(weight[l] for l in own), want[c])


def test_pieces_in_order(spark):
    text = "w1 " * 3000
    rows = packing.pack(frame(spark, [text, None]), 512).toPandas().sort_values(["doc_id", "piece"])
    ids = tokens.encoder().encode([text.encode()])[0]
    own = rows[rows["doc_id"] == 0]
    assert own["piece"].tolist() == list(range(len(own))) and own["start"].tolist() == [512 * k for k in range(len(own))]
    assert own["ids_crc32"].tolist() == [zlib.crc32(ids[a : a + 512].astype("<u4").tobytes()) for a in own["start"]] and own["length"].sum() == len(ids)


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "[[INST]", None, "", "a\\[/INST]\\\\</s>"]
    rows = [(k, i, ["user", "assistant", None, "tool"][(i + k) % 4], t, "x") for k in range(3) for i, t in enumerate(texts)]
    out = chat.read_back(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string"))).toPandas().set_index("conv_id")
    for k in range(3):
        own = [r for r in rows if r[0] == k]
        assert out.loc[k, "turns_sha256"] == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (out.loc[k, "loss_chars"], out.loc[k, "loss_sha256"], bool(out.loc[k, "valid_order"])) == (len(loss), hashlib.sha256(loss.encode()).hexdigest(), False)


def test_chat_with_another_template(spark):
    other = chat.Template(turn=(("mark", "<<", False), ("role", "", False), ("mark", "|", False), ("text", "", "trained"), ("mark", ">>", True), ("mark", "##", False)))
    rows = [(1, 0, "user", "a|b<<>>##", "x"), (1, 1, "assistant", "|<\\", "x")]
    out = chat.read_back(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string"), other), other).first()
    assert (out["n_turns"], out["turns_sha256"], out["valid_order"]) == (2, hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in rows).encode()).hexdigest(), True)
    with pytest.raises(ValueError):
        chat.Reader(chat.Template(turn=(("role", "", False), ("mark", "x", False))))


def test_simhash(spark, odd):
    rng = random.Random(9)
    base = [f"v{rng.randrange(500)}" for _ in range(300)]
    texts = list(odd)
    for k in range(25):
        w = list(base)
        w[rng.randrange(300)] = f"z{k}"
        texts.append(" ".join(w))
    rows = simhash.near_components(frame(spark, texts)).toPandas().set_index("doc_id")
    fp = [simhash.fingerprint((t or "").encode()) for t in texts]
    part = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 4:
                x, y = part[a], part[b]
                part = [min(x, y) if p in (x, y) else p for p in part]
    assert [int(rows.loc[i, "component_id"]) for i in range(len(texts))] == part
    assert [int(rows.loc[i, "fp"]) % 2**64 for i in range(len(texts))] == fp


def test_manhattan_never_exceeds_hamming():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**64, (2, 2000), np.uint64)
    assert (simhash.manhattan(simhash.embed(a), simhash.embed(b)) <= np.bitwise_count(a ^ b)).all()


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(docs)
    out = langid.identify(docs.select("doc_id", "text"), net).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.95
    empty = langid.identify(frame(spark, [None, "", "123 #"]), net).toPandas()
    assert set(empty["lang_pred"]) == {"und"} and set(langid.label_positions(net, "der und die".encode())) <= set(net.langs)
    assert langid.train(docs.where("doc_id < 0")) is None


def test_quality(spark, odd):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    weights = quality.train(docs.where("doc_id % 3 <> 0"), labels)
    out = quality.score(docs.where("doc_id % 3 = 0"), weights).join(labels, "doc_id").where("quality is not null and not base_failed").toPandas()
    assert (out["kept"].astype(int) == out["quality"]).mean() > 0.85
    rows = quality.score(frame(spark, odd), None).toPandas().set_index("doc_id")
    for i, t in enumerate(odd):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert tuple(rows.loc[i, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again)), i


def test_lines(spark):
    rng = random.Random(4)
    line = lambda n: " ".join(f"word{rng.randrange(3000)}" for _ in range(n))
    a, b = line(40), line(40)
    near = a.replace(a.split()[20], "changed")
    texts = [f"{a}\n{b}\n\n", f"{near}\nown {line(9)}", f"  {b.upper()} \n\nx", "x\nx", None, "", near]
    rows = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    assert [rows[i]["n_removed"] for i in range(7)] == [0, 1, 1, 2, 0, 0, 1]
    assert rows[0]["kept"] == texts[0] and rows[3]["kept"] == "" and rows[4]["kept"] is None and rows[2]["kept"] == "\nx" and rows[1]["label"] == "x"


@pytest.mark.parametrize("run", [substring.remove_repeats, suffix_array.remove_repeats, simhash.near_components, line_dedup.dedup_lines, packing.pack])
def test_empty_table(spark, run):
    assert run(frame(spark, [])).count() == 0


def test_line_shingles_of_any_length(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcé語😀 ") for _ in range(n)) for n in (1, 11, 12, 13, 75, 76, 139, 140, 4106, 4107, 4108, 9000)]
    size = line_dedup.SHINGLE
    parts = [(i, j, t[j : j + size]) for i, t in enumerate(texts) for j in range(max(1, len(t) - size + 1))]
    want = spark.createDataFrame(parts, "i int, j int, s string").selectExpr("i", "j", "xxhash64(s) h").collect()
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", line_dedup.shingle_hashes(F.col("t")).alias("h")).collect()
    assert sorted((r["i"], j, h) for r in got for j, h in enumerate(r["h"])) == sorted(map(tuple, want))


def lines_against_brute_force(spark, texts, least_links=1):
    """Each text is one line: those that go by all pairs of shingle sets, and by the operator."""
    size = line_dedup.SHINGLE
    low = [t.strip(" ").lower() for t in texts]
    sets = [{t[k : k + size] for k in range(max(1, len(t) - size + 1))} for t in low]
    part, links = list(range(len(texts))), 0
    for a in range(len(texts)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                links += 1
                x, y = part[a], part[b]
                if x != y:
                    part = [min(x, y) if p in (x, y) else p for p in part]
    assert links >= least_links
    rows = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    assert [i for i in range(len(texts)) if rows[i]] == [i for i, p in enumerate(part) if p != i]


def test_lines_of_one_template(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base, texts = [word() for _ in range(45)], []
    for _ in range(120):
        w = list(base)
        for k in rng.sample(range(45), rng.choice((1, 2))):
            w[k] = word()
        texts.append(" ".join(w))
    lines_against_brute_force(spark, texts, 50)


def test_shared_shingles_are_counted_once(spark):
    texts = spark.range(3).selectExpr("id k", "id k2", "concat('a line of some words ', id) line", "15 n")
    plan = line_dedup.links(texts, spark.createDataFrame([(0, 1)], "a long, b long"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") == 1


def family(rng, n, words, edits):
    """Lines of one template, each with some words of its own."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for k in rng.sample(range(words), rng.choice(edits)):
            w[k] = word()
        yield " ".join(w)


def test_lines_of_one_template_that_are_not_alike_are_not_verified(spark):
    docs = frame(spark, list(family(random.Random(5), 200, 70, (3, 4))))
    with common.workspace(spark) as own:
        met = own(line_dedup.buckets(line_dedup.signed(line_dedup.lines(docs))))
        assert met.where(F.col("m") > 100).count() > 0
        texts = own(line_dedup.texts_of(docs, met.select("k").distinct()))
        alone = spark.createDataFrame([], "k long, k2 long, component struct<k: long, k2: long>")
        assert line_dedup.rest_pairs(met, texts, alone).count() < 200 * 199 / 2 / 10


def test_bound_of_lines_rules_out_no_link(spark):
    rng = random.Random(6)
    texts = ["a", "b", "ab", *family(rng, 40, 3, (0, 1)), *family(rng, 60, 45, (0, 1, 2)), *family(rng, 60, 70, range(9)), *family(rng, 20, 700, range(0, 90, 5))]
    texts += ["na " * n for n in (5, 6, 40, 400)]  # few distinct shingles
    size = line_dedup.SHINGLE
    sets = [{t[k : k + size] for k in range(max(1, len(t) - size + 1))} for t in texts]
    alike = {(a, b) for b in range(len(texts)) for a in range(b) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])}
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, line string")
    texts_of = line_dedup.celled(rows.select("k", F.array_distinct(line_dedup.shingle_hashes(F.col("line"))).alias("hs"))).cache()
    every = rows.select(F.col("k").alias("a")).crossJoin(rows.select(F.col("k").alias("b"))).where("a < b")
    left = set(map(tuple, line_dedup.possible(texts_of, every).collect()))
    assert {r["k"]: r["n"] for r in texts_of.collect()} == {i: len(x) for i, x in enumerate(sets)}
    assert len(alike) > 300 and alike <= left and len(left) < len(texts) * (len(texts) - 1) / 4


def test_short_lines_edited_at_an_end(spark):
    base = ["newsletter subscription", "frequently asked questions", "telecommunications", "read more about the terms of use", "copyright notice and disclaimer of warranty"]
    texts = [v for t in base for v in (t, t + "!", t + "\r", "\u2022" + t, t[: len(t) // 2] + "-" + t[len(t) // 2 :])]
    lines_against_brute_force(spark, texts, 10)


def test_one_word_of_a_line_of_140_characters(spark):
    line = " ".join(["planet", "garden", "silver", "window", "bridge", "forest", "marble", "yellow", "castle", "pepper", "rocket", "violet", "basket", "copper", "meadow", "hollow", "tunnel", "dragon", "velvet", "canyon"])
    lines_against_brute_force(spark, [line, line.replace("pepper", "salted")])
    assert line_dedup.SHINGLE == 9


def test_simhash_with_more_groups(spark):
    assert simhash.groups_of(1000) == 7 and simhash.groups_of(10**9) > 8
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 30, np.uint64)
    fp = np.unique(np.concatenate([base, *(base ^ sum((np.uint64(1) << rng.integers(0, 64, 30, np.uint64) for _ in range(4)), np.uint64(0)) for _ in range(6))]))
    for groups in (8, 10):
        chosen = simhash.masks(groups)
        e = simhash.embed(fp)
        for a in range(len(fp)):
            for b in np.flatnonzero(np.bitwise_count(fp ^ fp[a]) <= 4):
                assert ((e[a] & chosen) == (e[b] & chosen)).any()


THUE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
OTHER = THUE.translate(str.maketrans("ab", "ba"))


def test_words_that_polynomials_confuse(spark):
    rest = [f"v{i}" for i in range(12)]
    rows = substring.remove_repeats(frame(spark, [" ".join([THUE, *rest]), " ".join([OTHER, *rest])])).orderBy("doc_id").toPandas()
    assert rows["n_removed"].tolist() == [0, 0]
    counts = quality.base_counts([f"{THUE} x y zz {OTHER} x y".encode(), f"{THUE} x y zz {THUE} x y".encode()])
    assert counts["n_repeat_words"].tolist() == [0, 6]
    w = [("a" * n).encode() for n in (1, 7, 8, 9, 16, 63, 64, 65, 200)] + [b"b", b"ab", b"ba"]
    h = [words.hashes(words.split([b" ".join(w)]), k) for k in (0, 1)]
    assert len(set(h[0])) == len(set(h[1])) == len(w) and not set(h[0]) & set(h[1])
    again = words.hashes(words.split([b"zz " + w[5], w[7] + b"  " + w[2]]))
    assert again.tolist()[1:] == [h[0][5], h[0][7], h[0][2]]


def test_quality_is_calibrated(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    weights = quality.train(docs.where("doc_id % 3 <> 0"), labels)
    out = quality.score(docs.where("doc_id % 3 = 0"), weights).join(labels.where("quality is not null"), "doc_id").toPandas()
    assert abs(out["p_quality"].mean() - out["quality"].mean()) < 0.1
    assert ((out["p_quality"] - out["quality"]) ** 2).mean() < 0.15


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net = langid.Network(["a", "b"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(0, 256, (6, 5)), rng.integers(0, 2, 5)
    _, g = net.gradients(x, y)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for i in np.flatnonzero(np.abs(g[name].reshape(-1)) > 1e-4)[:4]:
            was, step = flat[i], 1e-2
            flat[i] = was + step
            up = net.gradients(x, y)[0]
            flat[i] = was - step
            down = net.gradients(x, y)[0]
            flat[i] = was
            assert abs((up - down) / (2 * step) - g[name].reshape(-1)[i]) < 2e-3, name


def test_decontamination_in_blocks_and_with_names(spark, odd, monkeypatch):
    items = [("x9", odd[6]), ("x10", " ".join(odd[9].split()[:30])), ("x10", "one"), (None, "a b")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    one = decontaminate.contamination(frame(spark, odd), bench).toPandas().set_index("doc_id")
    several = decontaminate.automata
    monkeypatch.setattr(decontaminate, "automata", lambda b, w: several(b, w, most=50))
    assert decontaminate.contamination(frame(spark, odd), bench).toPandas().set_index("doc_id").equals(one)
    assert one.loc[6, "items_sha256"] == hashlib.sha256(b"x9").hexdigest() and one.loc[3, "items_sha256"] == hashlib.sha256(b"x10").hexdigest()
