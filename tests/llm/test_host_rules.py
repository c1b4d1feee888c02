"""Host rules: figures by brute force, and verdicts of hosts."""

import re
from collections import Counter

from llm.support import ODD, docs, texts
from tvlens.llm import host_rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_figures(spark):
    cases = [*ODD, "a b c a b c a b c d", "a a a a", "x\ny\nx\n \n \nx", "# * <b> 100%", *[t for _, t in texts()[:60]]]
    rows = {r.doc_id: r for r in host_rules.judge(docs(spark, cases)).collect()}
    for i, t in enumerate(cases):
        r, want = rows[i], plain(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_hosts(spark):
    good, bad = " ".join(f"word{i}" for i in range(60)), "too short"
    cases = [good] * 40 + [bad] * 60 + [good] * 300 + [bad, good] + [good]
    hosts = ["spam"] * 100 + [f"h{i % 10}" for i in range(300)] + ["tiny"] * 2 + [None]
    rows = host_rules.judge(docs(spark, cases, hosts)).collect()
    by = {h: {r.kept for r in rows if r.host == h and not r.base_failed} for h in set(hosts)}
    assert by["spam"] == {False} and by["tiny"] == {True} and by[None] == {True} and by["h3"] == {True}
    assert not any(r.kept for r in rows if r.base_failed)
    assert len(rows) == len(cases)


def test_defined_cases(spark):
    assert host_rules.judge(docs(spark, [])).count() == 0
    assert host_rules.judge(docs(spark, [(None, None), (None, "x"), (1, "x"), (1, "x")])).count() == 4
