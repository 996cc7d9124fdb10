from __future__ import annotations

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerline.llm.quality_rules import LineRules, judge_quality, line_fails, measure, op10_quality_rules
from tests.llm.samples import clashing, documents, empty, prose, words


def brute(text):
    text = text or ""
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    inside = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside), failed


def test_measures_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "\n\n", "a\na\n a\na", "ü " * 30, "\u2028x\u00a0y " * 12]
    texts += ["".join(rng.choice("ab \n\t|#é") for _ in range(rng.randint(0, 400))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in op10_quality_rules(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_lines_are_cut_and_documents_rejected(spark):
    clean = "\n".join(f"This is line {i} of a text, with words. {prose(i, 12)}." for i in range(6))
    texts = [clean, clean + "\nHome\nCopyright © all rights reserved\n###|||$$$ %%%", "\n".join(["Home | News | Sport | More"] * 12),
             "*** buy $$$ now ### " * 10, prose(1, 40), clean + "\n" + "\n".join([clean] * 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r.doc_id: r.quality_rules for r in judge_quality(df).collect()}
    assert [out[i].kept for i in range(6)] == [True, True, False, False, False, False]
    assert out[0].cleaned == clean and out[1].cleaned == clean and out[0].n_lost == 0


def test_edge_tables(spark):
    assert op10_quality_rules(empty(spark)).collect() == []
    wide = clashing(documents(spark))
    out = judge_quality(wide)
    assert out.where(F.col("quality_rules") == "quality_rules").count() == wide.count()


CLEAN = {
    "hindi": "यह एक सरल वाक्य है जिसमें कई शब्द हैं और इसका अर्थ {} लोगों को तुरंत समझ में आ जाता है।",
    "arabic": "هذه جملة بسيطة فيها كلمات كثيرة ومعناها واضح لكل من يقرأ النص رقم {} في هذا الكتاب القديم الجميل اليوم؟",
    "greek": "Αυτή είναι μια απλή πρόταση με πολλές λέξεις και το νόημά της είναι σαφές σε όποιον διαβάζει το {} κείμενο.",
    "russian": "Это простое предложение из многих слов и его смысл понятен каждому кто читает текст под номером {} в этой книге.",
    "amharic": "ይህ ብዙ ቃላት ያሉት ቀላል ዓረፍተ ነገር ነው እና ትርጉሙ ለሚያነብ ሁሉ ግልጽ ነው በዚህ መጽሐፍ ውስጥ ቁጥር {} ነው።",
    "armenian": "Սա պարզ նախադասություն է բազում բառերով և իմաստը հասկանալի է բոլորին ովքեր կարդում են այս գիրքը համար {} այսօր։",
}


def test_clean_text_of_six_scripts_is_kept():
    for name, line in CLEAN.items():
        *body, last = line.format("12").split()
        lines = [" ".join([*random.Random(i).sample(body, len(body)), last]) for i in range(5)]
        judged = measure("\n".join(lines).encode(), LineRules())
        assert judged["kept"] and judged["n_lost"] == 0, name


def test_words_about_cookies_and_symbols_by_characters():
    cookie = "She baked a chocolate cookie for every guest, and nobody left before the last one was gone."
    assert line_fails(cookie.encode(), 17, LineRules()) is None
    assert line_fails(b"This site uses cookies. Accept all cookies.", 7, LineRules()) == "boilerplate"
    for letter in ("e", "é", "ह"):
        assert line_fails(("####" + letter * 17).encode(), 1, LineRules()) is None
        assert line_fails(("####" + letter * 12).encode(), 1, LineRules()) == "symbols"


def test_a_text_above_a_megabyte():
    line = "A plain line of ten words that ends with number {}.\n"
    text = "".join(line.format(i) for i in range(40_000))
    judged = measure(text.encode(), LineRules())
    assert len(text) > 2_000_000 and judged["n_words"] == 440_000 and judged["n_dup_lines"] == 0 and judged["n_lost"] == 0
