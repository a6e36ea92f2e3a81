import random

import numpy as np
import pytest

from lexigraft.llm import pages
from lexigraft.llm.boosting import BoostedTrees
from lexigraft.llm.noise import Noise, edit, gap_keys
from lexigraft.llm.scans import Scans, normal_line

S, T = "source_id string, text string, sid string", "source_id string, relative_path string, chunk_index int, path string"
BASE = ("The rehabilitation unit described walking distance and the evening decoction eased steady numbness near the shoulder while the follow-up register "
        "listed several entries because transport was arranged after the family agreed that further notes were missing from the archive card . ")  # fmt: skip


LEARNED = Noise({("m", "rn"): (9.0, 3.0), ("d", "cl"): (9.0, 3.0), ("o", "0"): (9.0, 3.0), ("e", "c"): (9.0, 3.0), ("a", "x"): (1.0, 3.0)}, {("未", "末"): (5.0, 3.0)})


def test_page_values():
    for text, want in (("12", 12), ("[12]", 12), ("- 12 -", 12), ("· 7 ·", 7), ("48 / 69", 48), ("Page 3 of 9", 3), ("第 9 页 共 20 页", 9), ("第9页", 9), ("xiv", 14), ("mcm", None), ("cdxiv", None), ("12 mg", None), ("mild", None), ("", None)):
        assert pages.page_value(text) == want, text


def test_gapped_keys():
    alike = lambda a, b: bool(set(gap_keys(a)) & set(gap_keys(b)))
    assert alike("modern", "modem") and alike("held", "hcld") and alike("with", "vvith") and alike("a", "ab") and not alike("held", "hclc") and not alike("abcdefg", "xbcdefy")
    assert edit("modem", "modern") == ("rn", "m") and edit("tbe", "the") == ("h", "b") and edit("a", "a") == ("", "")
    assert len(gap_keys("x" * 5000)) <= 15003


def test_learned_spelling():
    for a, b in (("modern", "rnodcrn"), ("clinic", "dinic"), ("zero", "zer0"), ("未见", "末见")):
        assert LEARNED.fold(a) == LEARNED.fold(b), (a, b)
    assert LEARNED.fold("abc") != LEARNED.fold("xbc")  # seen once only
    assert LEARNED.misread("modern", random.Random(1)) != "modern" and LEARNED.misread("bbb", random.Random(1)) == "bbb"
    assert normal_line("Notes on X | Vol. 4, No. 2") == normal_line("NOTES on x | vol 17, No 9")


def test_layout():
    text = BASE * 6
    model = pages.fit_layout([text, text.replace("unit", "ward")] * 40)
    score = lambda t: model.score(np.array([pages.page_features(t)]))[0]
    assert all(score("\n".join(wrap(text, w))) > 0 for w in (40, 70, 120)) and score(text) < 0 and pages.page_features(" \n ") is None
    assert score("\n".join([*wrap(text, 70)[:12], text[:300]])) > 0  # one longer line


def test_trees():
    r = np.random.default_rng(0)
    x = r.random((400, 3))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    m = BoostedTrees().fit(x[:300], y[:300])
    assert ((m.score(x[300:]) > 0) == y[300:]).mean() > 0.93
    assert (BoostedTrees().fit(np.zeros((3, 2)), np.ones(3)).score(np.zeros((2, 2))) > 0).all()


def wrap(text, width):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) + 1 > width:
            out.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    return out + [line]


@pytest.fixture(scope="module")
def found(spark):
    typed = [(f"t{i}", BASE * 4 + f"Case {i} ended in twenty-two days .", "q") for i in range(30)] + [("z0", "未见好转，其间大便偏稀，口干已经消退，入冬以后家属同意继续观察，" * 20, "q")]
    body = wrap(BASE * 2, 60)
    pages, tasks = [], []
    for i in range(4):
        lines = ["HANDBOOK OF CASES" if i != 2 else "HANDB0OK OF CASES", ""] + list(body) + ["", f"- {i + 40} -"]
        if i == 1:
            lines[4] = lines[4].replace("the", "tbe", 1).replace("and", "arid", 1)
            lines[3] = lines[3].rsplit(" ", 1)[0] + " dis-"
            lines[4] = "tance " + lines[4]
        if i == 2:
            lines[5] = lines[5] + " the follow-"
            lines[6] = "up register " + lines[6]
        pages.append((f"s{i}", "\n".join(lines), "q"))
        tasks.append((f"s{i}", "scan/a.txt", i, "q"))
    pages.append(("s4", "\n".join(["HANDBOOK OF CASES", ""] + body[:-1] + [body[-1] + " num-", "", "- 44 -"]), "q"))
    pages.append(("s5", "\n".join(["HANDBOOK OF CASES", "", "bness " + body[0]] + body[1:] + ["", "- 45 -"]), "q"))
    tasks += [("s4", "scan/a.txt", 4, "q"), ("s5", "scan/a.txt", 5, "q"), ("s0", "scan/a.txt", 0, "again")]
    zh = "末见好转，其间犬便偏稀，口干己经消退，\n入冬以后家属同意继续观察，未见好转，其\n间大便偏稀，口干已经消退，入冬以后家属\n同意继续观察，未见好转，其间大便偏稀，\n口干已经消退"
    pages += [("h0", zh, "q"), ("n0", None, "q"), ("n1", "", "q"), ("n2", " \n ", "q"), ("s0", pages[0][1], "again"), ("l0", "list\n38\n37\n35", "q")]
    tasks += [("h0", "scan/b.txt", 0, "q"), ("l0", "notes/c.txt", 0, "q"), ("n0", "scan/a.txt", 9, "q")]
    out = Scans(spark.createDataFrame(typed + pages, S), spark.createDataFrame(tasks, T)).found()
    got: dict = {}
    for r in out.collect():
        got.setdefault(r.source_id, set()).add(r.noise)
    return got


def test_furniture(found):
    assert all({"header", "page_number"} <= found[f"s{i}"] for i in range(6)) and "l0" not in found and not any(k.startswith("t") for k in found)


def test_broken_words(found):
    assert [k for k in sorted(found) if "hyphenation" in found[k]] == ["s1", "s4"]  # follow-/up is a compound


def test_misread(found):
    got = {k for k in found if "misread" in found[k]}
    assert {"h0", "s1"} <= got and not got & {"s0", "s3"}, found


def test_nothing_in_nothing_out(spark, found):
    assert not {"n0", "n1", "n2"} & set(found)
    empty = Scans(spark.createDataFrame([], S), spark.createDataFrame([], T)).found()
    assert empty.count() == 0


def wide_pages(width, word="immunosuppresslov"):
    """Three pages of one file with a running line, lines of ``width`` and one misread word each."""
    out, words = [], (BASE * 6).split()
    for i in range(3):
        lines = [f"NOTES ON DISORDERS {i + 7}", "", *wrap(" ".join(words[11 * i :] + words[: 11 * i]) + f" then {word} was seen .", width)]
        out.append((f"w{i}", "\n".join(lines), "q"))
    return out, [(f"w{i}", "scan/w.txt", i, "q") for i in range(3)]


@pytest.mark.parametrize("width", [70, 120])
def test_any_width_and_unlearned_misreading(spark, width):
    rows, tasks = wide_pages(width)
    typed = [(f"t{i}", BASE * 4 + f"The immunosuppression was level {i} .", "q") for i in range(20)]
    got = {(r.source_id, r.noise) for r in Scans(spark.createDataFrame(typed + rows, S), spark.createDataFrame(tasks, T)).found().collect()}
    assert {(f"w{i}", "header") for i in range(3)} <= got and {(f"w{i}", "misread") for i in range(3)} <= got, got


def test_without_flowing_pages(spark):
    rows, tasks = [], []
    for i in range(12):
        text = BASE * 3 + "with immunosuppression noted . " + BASE
        lines = wrap(text, 60)
        if i == 3:
            lines[5:6] = [lines[5][:-4].rsplit(" ", 1)[0] + " immunosup-", "pression " + lines[5]]
        rows.append((f"p{i}", "\n".join(lines), "q"))
        tasks.append((f"p{i}", f"scan/{i}.txt", 0, "q"))
    got = {(r.source_id, r.noise) for r in Scans(spark.createDataFrame(rows, S), spark.createDataFrame(tasks, T)).found().collect()}
    assert ("p3", "hyphenation") in got, got
