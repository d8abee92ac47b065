from caseflow.llm import quality
from tests.llm.conftest import EDGE, frame


def by_id(df):
    return {r.doc_id: r for r in quality.judge_documents(df).collect()}


def test_edge_rows(edge, nothing):
    out = quality.judge_documents(edge).collect()
    assert len(out) == len(EDGE) and quality.judge_documents(nothing).count() == 0
    rows = {r.doc_id: r for r in out}
    for i in (1, 2, 3):
        assert (rows[i].n_words, rows[i].word_chars, rows[i].n_repeat_words, rows[i].base_failed, rows[i].kept) == \
            (0, 0, 0, True, False)
    assert rows[2].clean_text is None and rows[1].clean_text == ""
    assert rows[8].n_words == 60_003 and rows[8].base_failed  # the long text repeats its windows
    assert rows[7].n_symbols == 4
    assert rows[9].n_symbols == 3
    assert rows[-12].n_dup_lines == 1


def test_lines_are_removed_before_the_document_is_judged(spark):
    good = " ".join(f"word{i}" for i in range(80)) + "."
    nav = " | ".join(f"Item{i}" for i in range(150))
    rows = by_id(frame(spark, [(1, good, "en", "a"), (2, f"{good}\nAll rights reserved.", "en", "a"),
                               (3, f"{good}\n{nav}", "en", "a"), (4, good[:-1], "en", "a")], []))
    assert rows[1].kept and rows[1].n_bad_lines == 0 and rows[1].clean_text == good
    assert rows[2].kept and rows[2].clean_text == good
    assert not rows[3].kept and rows[3].clean_text == good and not rows[3].base_failed
    assert not rows[4].kept


def test_repeated_windows(spark):
    rows = by_id(frame(spark, [(1, "a b c a b c", "en", "s"), (2, "a b c d a b c", "en", "s"), (3, "a a a a", "en", "s"),
                               (4, "a b", "en", "s"), (5, "x y z\ty q", "en", "s")], []))
    assert [rows[i].n_repeat_words for i in range(1, 6)] == [6, 6, 4, 0, 0]


def test_each_removed_line_is_named_by_its_rule(spark):
    lines = {  # line: the rule it fails
        "I baked a cookie today and it was very good.": None,
        "Users log in with a password that the office hands out each year.": None,
        "She subscribed to two magazines.": None,
        "The ratio of a / b and of c / d was printed beside every figure of the long chapter on rates, as he asked.": None,
        "\t ": None,
        "Log in.": "boilerplate",
        "Read our Privacy Policy!": "boilerplate",
        "© 2020 Alle Rechte vorbehalten.": "boilerplate",
        "Lire la suite.": "boilerplate",
        "Este sitio utiliza cookies para mejorar la experiencia de quienes lo visitan.": "boilerplate",
        "Home | News | Contact.": "navigation",
        "Home > Garden > Tools.": "navigation",
        "Chapter one": "no_end",
    }
    got = by_id(frame(spark, [(i, line, "en", "a") for i, line in enumerate(lines)], []))
    for i, (line, rule) in enumerate(lines.items()):
        assert [getattr(got[i], f"n_{r}") for r in quality.RULES] == [int(r == rule) for r in quality.RULES], line
        assert got[i].n_bad_lines == int(rule is not None)
    whole = by_id(frame(spark, [(1, "\n".join(lines), "en", "a")], []))[1]
    assert (whole.n_boilerplate, whole.n_navigation, whole.n_no_end) == (5, 2, 1)
    assert whole.clean_text.split("\n") == [line for line, rule in lines.items() if rule is None]
