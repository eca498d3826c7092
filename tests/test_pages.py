"""Questions from page geometry: pages drawn here and read back."""

from kedge.operators import pages

SPAN, BOX = "document string, page int, x0 double, y0 double, x1 double, y1 double, text string, bold boolean", "document string, page int, x0 double, y0 double, x1 double, y1 double"


def _page(doc, page, tops, xs):
    """Rules of a table with these row edges and column edges."""
    rules = [(doc, page, float(xs[0]), float(y), float(xs[1]), y + 0.5) for y in tops]
    return rules + [(doc, page, float(x), float(tops[0]), x + 0.5, float(tops[-1])) for x in xs]


def _span(doc, page, x, y, text, bold=False):
    return (doc, page, float(x), float(y), x + 6.0 * len(text), y + 10.0, text, bold)


def test_numbered(spark):
    xs = (30, 80, 300, 500, 800)
    boxes = _page("d", 1, (100, 130, 200, 300), xs) + _page("d", 2, (100, 200, 300, 400), xs)
    spans = [
        _span("d", 1, 40, 105, "№"), _span("d", 1, 90, 105, "Вопрос"),
        _span("d", 1, 40, 135, "1."), _span("d", 1, 90, 135, "Какой огонь "), _span("d", 1, 170, 136, "несёт"), _span("d", 1, 90, 150, "буксир?"),
        *[_span("d", 1, 510, 135 + 14 * i, f"• ответ {i}", i == 2) for i in range(4)],
        _span("d", 1, 40, 205, "2"), _span("d", 1, 90, 205, "Начало"), _span("d", 1, 510, 205, "Один ответ"),
        _span("d", 2, 90, 105, "и конец"), _span("d", 2, 510, 105, "идёт дальше"), _span("d", 2, 40, 205, "4."), _span("d", 2, 90, 205, "Третий"), _span("d", 2, 90, 305, "ничей"),
    ]
    pictures = [("d", 1, 310.0, 140.0, 400.0, 190.0, "h1"), ("d", 1, 600.0, 140.0, 700.0, 190.0, "h2")]
    legend = spark.createDataFrame([("d", True)], "document string, legend boolean")
    s, b = spark.createDataFrame(spans, SPAN), spark.createDataFrame(boxes, BOX)
    records, issues = pages.numbered_questions(s, b, legend=legend, pictures=spark.createDataFrame(pictures, BOX + ", sha256 string"))
    got = {r.reference_id: r for r in records.collect()}
    one, two, three = got["d:1"], got["d:2"], got["d:3"]
    assert (one.question_text, one.raw_question_text, one.question_number) == ("Какой огонь несёт буксир?", "Какой огонь несёт\nбуксир?", "1.")
    assert one.published_answers == [f"ответ {i}" for i in range(4)] and one.published_correct_answer_indexes == [2] and one.published_correct_answer == "ответ 2" and one.answer_structure == "full_options" and one.illustrations == ["h1"] and one.issues == []
    assert two.question_text == "Начало и конец" and two.published_answers == ["Один ответ идёт дальше"] and two.answer_structure == "published_answer_only" and two.issues == ["page_continuation", "unknown_correctness"] and [r.page for r in two.row_refs] == [1, 2]
    assert three.issues == ["incomplete_content", "unknown_correctness"] and three.published_answers == []
    assert sorted((r.issue, r.page) for r in issues.collect()) == [("nonsequential_numbers", None), ("unrecognized_row", 2)]
    empty, none = pages.numbered_questions(s.limit(0), b, legend=legend)
    assert empty.count() == 0 and none.count() == 0 and pages.numbered_questions(s, b.limit(0), legend=legend)[0].count() == 0


def test_coded(spark):
    xs = (50, 100, 320, 510, 790)
    boxes = _page("d", 1, (100, 120, 200, 300), xs) + _page("d", 2, (150, 250), xs) + _page("e", 1, (100, 200), xs)
    spans = [
        _span("d", 1, 60, 40, "М.1 Огни и"), _span("d", 1, 60, 55, "знаки"), _span("d", 1, 60, 85, "далеко"),
        _span("d", 1, 110, 105, "Вопрос"), _span("d", 1, 330, 105, "Иллюстрация"),
        _span("d", 1, 60, 125, "М.1.2."), _span("d", 1, 110, 125, "Какой огонь?"), _span("d", 1, 520, 125, "первый"), _span("d", 1, 520, 137, "ответ"), _span("d", 1, 520, 150, "второй"), _span("d", 1, 520, 163, "третий", True),
        _span("d", 1, 60, 205, "так"), _span("d", 1, 110, 205, "не код"),
        _span("d", 2, 60, 60, "М.2 Сигналы"), _span("d", 2, 110, 155, "и знак?"), _span("d", 2, 520, 155, "• да"),
        _span("e", 1, 110, 105, "ничей"),
    ]
    s, b = spark.createDataFrame(spans, SPAN), spark.createDataFrame(boxes, BOX)
    records, issues = pages.coded_questions(s, b)
    (r,) = records.collect()
    assert (r.code, r.prefix, r.section_code, r.section_title, r.question_text) == ("М.1.2.", "М", "М.1", "Огни и знаки", "Какой огонь? и знак?")
    assert r.answers == ["первый ответ", "второй", "третий", "да"] and r.correct == 2 and r.issues == ["page_continuation", "answer_boundaries_inferred"]
    assert sorted((x.document, x.issue, x.detail) for x in issues.collect()) == [("d", "invalid_code", "так"), ("e", "orphan_row", "")]
    lit = spark.createDataFrame([("d", 1, 500.0, 150.0, 700.0, 162.0)], BOX)
    assert pages.coded_questions(s, b, highlights=lit)[0].collect()[0].correct is None
