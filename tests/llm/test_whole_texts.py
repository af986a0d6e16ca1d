"""Operators of ``shopfloor.llm`` on texts and words beyond the usual lengths."""

import math

import numpy as np
import pytest

from shopfloor.llm import catalog, language_id, lattice_lm, mixing, secret_scan


def test_language_margin_does_not_fall_with_length(spark):
    catalog.ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where("doc_id % 4 <> 2"))
    for lang in [name for name, _ in model]:
        texts = [r["text"] for r in docs.where("lang is not null and text is not null").where(docs["lang"] == lang).orderBy("doc_id").collect()]
        whole = " ".join(texts)[:1_200_000]
        assert len(whole) >= 1_000_000
        rows = spark.createDataFrame([(1, whole), (2, whole[:100_000])], "doc_id long, text string")
        long, short = language_id.predict(rows, model, ["doc_id"]).orderBy("doc_id").collect()
        assert long["lang_pred"] == short["lang_pred"] == lang and long["accepted"]
        assert long["margin"] == pytest.approx(short["margin"], rel=0.3)
        assert language_id.accepted_documents(rows, model).count() == 2


def test_lattice_of_long_words():
    """Words of several slices against a plain recursion over every piece."""
    p = {"▁": 0.1, "a": 0.2, "b": 0.1, "ab": 0.15, "▁a": 0.05, "ba": 0.07, "abbab": 0.02, "éa": 0.03}
    own = lattice_lm.Lattice(list(p), np.log(np.array(list(p.values()))), math.log(0.001))

    def plain(word):
        """Log probability and expected piece counts of a word."""
        s, ways = "▁" + word, []
        for j in range(len(s) + 1):
            steps = [(j - n, piece, math.log(p[piece])) for n in range(1, 6) if j >= n and (piece := s[j - n : j]) in p]
            if j and s[j - 1] not in p:
                steps.append((j - 1, None, len(s[j - 1].encode()) * math.log(0.001)))
            ways.append(steps)
        alpha = [0.0]
        for steps in ways[1:]:
            alpha.append(np.logaddexp.reduce([alpha[i] + lp for i, _, lp in steps]))
        beta, counts = [-math.inf] * len(s) + [0.0], dict.fromkeys(p, 0.0)
        in_bytes = 0.0
        for j in range(len(s), 0, -1):
            for i, piece, lp in ways[j]:
                beta[i] = np.logaddexp(beta[i], lp + beta[j])
                share = math.exp(alpha[i] + lp + beta[j] - alpha[-1])
                if piece is None:
                    in_bytes += share * len(s[i].encode())
                else:
                    counts[piece] += share
        return alpha[-1], list(counts.values()), in_bytes

    found = ["ab" * 100 + "b", "abbab" * 600, "a" * 254, "b" * 255, "a" * 256, "éab" * 300, "ab", "abba" * 129]
    wanted = [plain(w) for w in found]
    assert own.scores(found) == pytest.approx([w[0] for w in wanted], rel=1e-12)
    weights = np.arange(1.0, len(found) + 1)
    counts, in_bytes = own.expect(found, weights)
    assert counts == pytest.approx(weights @ np.array([w[1] for w in wanted]), rel=1e-9)
    assert in_bytes == pytest.approx(weights @ [w[2] for w in wanted], rel=1e-9)


def test_secrets_of_many_literals_and_long_names():
    joined = " + ".join(f'"ab{i:03d}Q"' for i in range(100))
    assert len(secret_scan.lexed_spans(f"big = {joined}\npassword = big")) == 100
    assert "Q" not in secret_scan.mask(f"big = {joined}\npassword = big")
    chain = 'c0 = "ab000Q"\n' + "".join(f'c{i} = c{i - 1} + "ab{i:03d}Q"\n' for i in range(1, 3000)) + "password = c2999"
    assert len(secret_scan.lexed_spans(chain)) == 3000
    doubled = 'x = "Zk39fQx81LmP"\n' + "x = x + x\n" * 2000 + "password = x"
    assert [doubled[s:e] for s, e, _ in secret_scan.lexed_spans(doubled)] == ["Zk39fQx81LmP"]
    for name in ("api_access", "API_SIGNING", "accessSigning", "signing_encryption", "password_" + "x" * 300, "password : " + "T" * 300, "password" + " " * 200):
        text = f'{name} = "Zk39fQx81LmP"'
        assert [text[s:e] for s, e, _ in secret_scan.lexed_spans(text)] == ["Zk39fQx81LmP"]
    assert secret_scan.value_score("x" * 300) == secret_scan.value_score("example " + "q1Z" * 99) == 0 < secret_scan.value_score("x" * 40 + "Q1" * 40 + "x" * 40)


def test_mixing_keeps_white_space_and_foreign_columns(spark):
    catalog.ship(spark)
    rows = [(i, f"\tdef f{i}():\n" + "".join(f"    x{j} = {i}\n\n" for j in range(30)), "ab"[i % 2], -5, "s", 9, 0.5) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, src string, start long, target double")
    # ``most`` and ``share`` of one: every document is taken whole, once
    got = {r["doc_id"]: r for r in mixing.mix_documents(docs, share=1.0, most=1.0, weights=(1.0,)).collect()}
    assert {i: tuple(r) for i, r in got.items()} == {r[0]: r for r in rows}
    words = mixing.mixed_blocks(docs, ["doc_id", "size"], share=1.0, most=1.0, weights=(1.0,)).collect()
    assert sum(r["words"] for r in words) == sum(len(r[1].split()) for r in rows) and {r["size"] for r in words} == {-5}
    text = b" a\n\nb\tc  d\n"
    assert mixing.cut_out(text, [(0, 2, 1), (2, 2, 1)]) == text
    assert mixing.cut_out(text, [(0, 2, 2), (3, 1, 1)]) == b" a\n\nb d\n a\n\nb"


def test_language_sample_uses_all_rows(spark, monkeypatch):
    catalog.ship(spark)
    made = [(i, " ".join(f"{a}{b}{chr(97 + i % 26)}{chr(97 + i // 26)}" for a in "klm" for b in "aeiou"), "aa") for i in range(400)]
    made += [(1000 + i, " ".join(f"{a}{b}{chr(97 + i % 26)}{chr(97 + i // 26)}" for a in "xyz" for b in "aeiou"), "zz") for i in range(500)]
    made.append((5000, "wall of text " * 50_000, "aa"))
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = language_id.fit(docs, dict_bytes=30_000)
    assert [lang for lang, _ in model] == ["zz", "aa"]  # by all labelled rows, not by the capped sample
    held = model[1][1].decode()
    assert sum(language_id.letters(t).split()[0] in held.split() for i, t, lang in made if lang == "aa") >= 290
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(docs)


def test_names_are_read_in_linear_time():
    import time

    text = "key " + "a-" * 500_000 + "]] = 1"
    start = time.perf_counter()
    assert secret_scan.lexed_spans(text) == []
    assert time.perf_counter() - start < 2
    for target, name in (("api_key", "api_key"), ("x: str", "x"), ('conf["token"]', "token"), ("9a.b-c'  ", "a.b-c"), ("a : Map[str]\t", "a"), ("]]", None), ("12 : int", "int"), ("'k' : v", "v")):
        assert secret_scan._name_left(target, len(target)) == name


def test_vowel_signs_stay():
    assert language_id.letters("हिन्दी, भाषा 12_x") == "हिन्दी भाषा x"
    assert language_id.letters("\u0301 12") == ""
