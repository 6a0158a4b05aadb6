import re
from collections import Counter

from ledgerline.llm.quality import Rule, quality_rules

from .helpers import AWKWARD, docs_of, empty_docs, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    repeat = {k for i, w in enumerate(windows) if count[w] > 1 for k in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(repeat), len(words) < 10 or 100 * len(repeat) > 20 * len(words))


def check(spark, rows):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                   r["n_repeat_words"], r["base_failed"]) for r in quality_rules(docs_of(spark, rows)).collect())
    assert got == Counter((d, *brute(t)) for d, t in rows)


def test_awkward_rows(spark):
    check(spark, AWKWARD)
    rows = quality_rules(docs_of(spark, AWKWARD)).where("doc_id in (2, 3, 4)").collect()
    assert all(r["base_failed"] and not r["kept"] for r in rows)
    assert quality_rules(empty_docs(spark)).count() == 0


def test_repeats_and_symbols(spark):
    a, b = prose(1, 40), prose(2, 30)
    rows = [(1, " ".join(a + b + a)), (2, " ".join(a + a[3:20] + b)), (3, "a a a a a a a a a a a a"),
            (4, "# * $ % & | < > x#y\x0b\x0cz\n\nline one\nline one\n \nline one "), (5, " ".join(a))]
    check(spark, rows)


def test_own_threshold_table(spark):
    rules = (Rule("long", "n_words", high=3), Rule("symbols", "symbol_ratio", high=0.0))
    rows = quality_rules(docs_of(spark, [(1, " ".join(prose(3, 20)) + " $"), (2, " ".join(prose(4, 12)))]), rules).collect()
    assert {r["doc_id"]: r["failed_rules"] for r in rows} == {1: "long,symbols", 2: "long"}


def test_native_plan_without_shuffle(spark):
    plan = quality_rules(docs_of(spark, AWKWARD))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_a_rule_holds_from_its_number_of_words_on(spark):
    rules = (Rule("plain", "stop_word_ratio", low=0.5), Rule("from_20", "stop_word_ratio", low=0.5, min_words=20))
    rows = quality_rules(docs_of(spark, [(1, " ".join(prose(5, 19))), (2, " ".join(prose(6, 20))), (3, "the " * 30), (4, None)]),
                         rules).collect()
    assert {r["doc_id"]: r["failed_rules"] for r in rows} == {1: "plain", 2: "plain,from_20", 3: "", 4: "plain"}
