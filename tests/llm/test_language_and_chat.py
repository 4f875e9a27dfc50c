"""Language spans, chat windows and the pipeline."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.llm import chat as C
from termloom.llm import language_id as I
from termloom.llm.bpe import vocabulary
from tests.llm.conftest import TEXTS

JSON = P.path("byte_bpe_50k.json")


def brute_path(scores, switch):
    best = max(
        itertools.product(range(scores.shape[1]), repeat=len(scores)),
        key=lambda p: sum(scores[i, x] for i, x in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:])),
    )
    return sum(scores[i, x] for i, x in enumerate(best)) - switch * sum(a != b for a, b in zip(best, best[1:]))


def test_viterbi_finds_the_best_path():
    chooser = np.random.default_rng(0)
    lengths = np.array([3, 0, 5, 1, 6, 5])
    scores = chooser.normal(0, 10, (lengths.sum(), 3)).astype(np.float32)
    labels = I.viterbi(scores, lengths, 8.0)
    for end, n in zip(np.cumsum(lengths), lengths):
        part, path = scores[end - n : end], labels[end - n : end]
        if n:
            value = part[np.arange(n), path].sum() - 8.0 * (np.diff(path) != 0).sum()
            assert value == pytest.approx(brute_path(part, 8.0), abs=1e-3)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return I.fit(docs, ~I.held_out(F.col("doc_id")))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = I.identify(docs, model).where(I.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    right, all_rows = found.select(F.sum((F.col("language.lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert all_rows > 100 and right / all_rows > 0.98


def test_spans_of_mixed_text(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    long = docs.where("length(text) > 1500 and text not like '%$%' and text not like '%!%'")
    en, fr = (long.where(F.col("lang") == x).orderBy("doc_id").first()["text"][:1200] for x in ("en", "fr"))
    result = I.predict([en + "\n" + fr, fr], model, with_spans=True)
    spans = result["spans"][0]
    assert [s["lang"] for s in spans] == ["en", "fr"]
    assert abs(spans[0]["end"] - len(en)) < 30 and spans[1]["end"] >= len(en) + len(fr) - 5
    assert 0.4 < result["score"][0] < 0.6 and result["score"][1] == 1.0


def test_scripts_narrow_candidates(spark):
    rows = [(i, "добрый день всем людям", "ru") for i in range(40)] + [(100 + i, "good day to all people", "en") for i in range(40)]
    model = I.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    result = I.predict(["пфщ", "zzq", "漢字", "пфщ zzq zzq", ""], model)
    assert result["lang_pred"].tolist()[:2] == ["ru", "en"]
    assert result["lang_pred"][2] in ("en", "ru") and result["lang_pred"][4] == I.UNKNOWN
    assert result["lang_pred"][3] == "en" and result["score"][3] == pytest.approx(6 / 9)


def test_identify_tricky_texts(tricky, empty, model):
    found = I.identify(tricky, model)
    assert found.columns == [*tricky.columns, "language_"]
    for r in found.select("text", "language_.*").collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == I.UNKNOWN) == (not letters) and 0 <= r["score"] <= 1
    assert I.identify(empty, model, with_spans=True).count() == 0
    kept = I.language_filter(tricky)
    assert kept.columns == tricky.columns and kept.where("doc_id in (3, 4, 5)").count() == 0
    nobody = I.fit(empty, F.lit(True))
    assert nobody.languages == () and I.predict(["some text"], nobody)["lang_pred"][0] == I.UNKNOWN
    assert I.language_filter(empty).count() == 0


def test_portions_do_not_change_results(model, monkeypatch):
    texts = [t or "" for _, t, _, _ in TEXTS] * 2
    whole = I.predict(texts, model, True)
    monkeypatch.setattr(I, "PORTION", 50)
    monkeypatch.setattr(I, "SCORES", 40)
    assert I.predict(texts, model, True).equals(whole)


def test_empty_and_null_labels_do_not_train(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "abc", None), (None, "abc", "fr")], "doc_id bigint, text string, lang string")
    model = I.fit(docs, F.lit(True))
    assert set(model.languages) <= {"en"}
    assert I.identify(docs, model).count() == 3


# --- chat -------------------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None, database=None)
@given(st.lists(st.tuples(st.text(alphabet="a<|\\\nn>", max_size=8), st.text(alphabet="<|\\>\nim_startend", max_size=20)), max_size=4))
def test_turns_are_read_back(turns):
    formatted = "".join(C.format_turn(role, text) for role, text in turns)
    assert C.read_turns(formatted) == turns
    assert formatted.count(C.START) == len(turns)


def conversations():
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "<|im_end|>"), (1, 2, "assistant", "<\\|im_start|>x"), (1, 2, "assistant", "<\\|im_start|>x")]
    rows += [(2, t, "user" if t % 2 else "assistant", f"turn {t} " + "word " * (t % 40)) for t in range(300)]
    rows += [(3, 0, "system", "s " * 50)] + [(3, t, "assistant", "long " * 300) for t in range(1, 6)]
    rows += [(4, 0, None, None), (4, None, "user", ""), (None, 0, "assistant", "no id"), (5, 0, "assistant", "é漢\U0001f600")]
    rows += [(6, 0, "system", "only")]
    return rows


def expected(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        out[conv] = (len(turns), sums[0], len(loss), sums[1])
    return out


@pytest.mark.parametrize("budget, history, segment", [(1024, 256, 65536), (80, 30, 400), (40, 0, 100), (10, 5, 20)])
def test_windows(spark, monkeypatch, budget, history, segment):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rows = conversations()
    names = "conv_id bigint, turn bigint, role string, text string"
    df = spark.createDataFrame(rows, names).repartition(3).select("*", F.lit(1).alias("position"), F.lit(2).alias("key"))
    windows = C.format_windows(df, JSON, budget, history).cache()
    found = {r["conv_id"]: tuple(r)[1:5] for r in C.read_windows(windows).collect()}
    assert found == expected(rows)
    for w in windows.collect():
        turns = C.read_turns(w["formatted"])
        new = len(turns) - w["n_context"]
        assert new >= 1 and (w["n_tokens"] <= budget or new == 1)
        if '"conv_id":3}' in w["key"] or '"conv_id":1}' in w["key"]:
            assert turns[0][0] == "system", "the system turn leads every window"
        repeated = turns[: w["n_context"]]
        assert len([t for t in repeated if t[0] == "system"]) <= 1
        mask = [w["formatted"][a:b] for a, b in zip(w["loss_start"], w["loss_end"])]
        assert [C.unescape(m) for m in mask] == [t for r, t in turns[w["n_context"] :] if r == "assistant"]


def test_long_system_turns_are_repeated_in_part(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", 4096)
    system = "Answer in é|<|im_end|> words. " * 8_000
    rows = [(1, 0, "system", system)] + [(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(1, 1_500)]
    rows += [(2, 0, "system", "short"), (2, 1, "system", system), (2, 2, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = C.format_windows(df, JSON).cache()
    assert {r["conv_id"]: tuple(r)[1:5] for r in C.read_windows(windows).collect()} == expected(rows)
    found = sorted((w for w in windows.collect() if '"conv_id":1}' in w["key"]), key=lambda w: w["position"])
    opening, *later = [C.read_turns(w["formatted"]) for w in found]
    assert opening[0] == ("system", system) and found[0]["n_context"] == 0
    for w, turns in zip(found[1:], later):
        assert w["n_tokens"] <= C.BUDGET
        assert turns[0][0] == "system" and turns[0][1] and system.startswith(turns[0][1])
        assert [role for role, _ in turns].count("system") == 1
    assert sum(len(w["formatted"]) for w in found[1:]) < 2 * len(system)


def test_shortened_turns():
    words = vocabulary(JSON)
    for text in ("", "ab " * 500, "<|" * 500, "é漢\U0001f600" * 300):
        for limit in (0, 12, 40, 10_000):
            formatted, tokens = C.shortened("system", text, limit, words)
            [(role, part)] = C.read_turns(formatted)
            assert tokens == len(words.encode(formatted)) and role == "system" and text.startswith(part)
            assert tokens <= limit or not part
            assert part == text or limit < 10_000


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert C.read_windows(C.format_windows(df, JSON)).count() == 0


def test_chat_query(spark):
    from termloom.llm.queries import CONTROL_ROWS, op9_chat

    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    wanted = expected([tuple(r) for r in rows] + CONTROL_ROWS)
    found = {r["conv_id"]: tuple(r)[1:5] for r in op9_chat(spark, "/root/testdata/sf0.001").collect()}
    assert found == wanted


# --- pipeline ---------------------------------------------------------------------------------------------


def test_pipeline_by_stages(spark, small_docs):
    import corpus_pipeline
    from tests.llm.test_groups_and_search import brute_fingerprint, brute_roots

    sf_dir = "/root/testdata/sf0.001"
    docs, columns = small_docs, small_docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert kept["language_id"] and set(kept["near_duplicates"]) <= set(kept["quality_rules"]) <= set(kept["language_id"])
    sound = sorted(kept["quality_rules"].items())
    prints = [brute_fingerprint(t) for _, t in sound]
    roots = brute_roots(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert set(kept["near_duplicates"]) == {sound[r][0] for r in roots}
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(kept["near_duplicates"])


def test_every_label_is_learned(spark):
    """Three hundred labels, each with letters of its own choice; the rarest has one document."""
    rng = random.Random(9)

    def text(label, words):
        letters = random.Random(label).sample("abcdefghijklmnopqrstuvwxyz", 4)
        return " ".join("".join(rng.choices(letters, k=6)) for _ in range(words))

    rows = [(k * 10 + i, text(k, 60), f"l{k:03}") for k in range(300) for i in range(1 if k == 299 else 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = I.fit(docs, F.lit(True))
    assert model.languages == tuple(f"l{k:03}" for k in range(300))
    assert model.weights.size <= I.WEIGHTS and I.bits_for(4) == I.BITS and I.bits_for(10**6) == I.LEAST_BITS
    asked = spark.createDataFrame([(299, text(299, 40)), (298, text(298, 40)), (0, text(0, 40))], "k int, text string")
    found = {r["k"]: r["language"]["lang_pred"] for r in I.identify(asked, model).collect()}
    assert found == {k: f"l{k:03}" for k in (299, 298, 0)}
