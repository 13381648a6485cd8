from __future__ import annotations

import html as pyhtml
import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casewright.functions import elements as el
from casewright.functions import fields, html, paths

C = F.col("c")
few = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def document(*parts):
    return json.dumps({"document": {"elements": [{"id": i, **p} for i, p in enumerate(parts)]}})


def table(*rows, tag="td"):
    body = "".join("<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in r) + "</tr>" for r in rows)
    return {"type": "table", "content": f"<table>{body}</table>"}


def test_unescape_is_single_pass(evaluate):
    given_ = ["<td>A&amp;B&nbsp;<b>c</b></td>", "&amp;lt;", "no entity", "&notit; &notin; &copy &ampx"]
    assert evaluate(html.unescape(C), c=given_) == [pyhtml.unescape(t) for t in given_]
    assert evaluate(html.cell_text(C), c=given_[:2]) == ["A&B c", "&lt;"]


references = st.lists(
    st.lists(
        st.sampled_from(
            "&amp; &lt &gt; &euro; &#8364; &#x20AC; &#0; &#150; &#xD800; &#1114112; &#xFFFE; & ; # x "
            "&bogus; &#; &#x; &notin; &not; &AMP &#99999999999 &#00065; text é".split(" ")
        ),
        max_size=6,
    ).map("".join),
    min_size=1,
    max_size=30,
)


@few
@given(references)
def test_unescape_matches_the_standard(evaluate, texts):
    assert evaluate(html.unescape(C), c=texts) == [pyhtml.unescape(t) for t in texts]


def test_table_cells(evaluate):
    t = "<TABLE><tr class='a'><th>H</th></tr><tr></tr>\n<TR><td>a\n b</td><Td x=1><i>c</i>d</td></TR>"
    assert evaluate(html.table_cells(C), c=[t]) == [[["H"], [], ["a b", "c d"]]]


def test_page_elements(evaluate):
    page = (
        "<style>p{}</style><h1>A</h1><script>'<p>no</p>'</script><p>b<br><p>c &lt; d</p>"
        "<table><tr><td><p>x</p></td></tr></table><li>q<!-- <p>hidden</p> --><p> </p>"
    )
    got = [tuple(e) for e in evaluate(html.page_elements(C), c=[page])[0]]
    assert got == [
        ("0", "section_header", "A"),
        ("1", "text", "b"),
        ("2", "text", "c < d"),
        ("3", "table", "<table><tr><td><p>x</p></td></tr></table>"),
        ("4", "text", "q"),
    ]


def test_paths(evaluate):
    given_ = ["/v/case_07/invoice_7.pdf", r"\v\case_1\a.pdf", "/x/y.pdf", "/v/case_1.pdf"]
    assert evaluate(paths.case_id(C), c=given_) == ["case_07", "case_1", "y", "case_1.pdf"]
    assert evaluate(paths.document_id(C), c=given_) == ["invoice_7", r"\v\case_1\a", "y", "case_1"]
    assert evaluate(paths.role(C), c=["/a/Royalty_1.PDF", "/a/x.pdf", "declaration_2"]) == [
        "royalty", None, "declaration",
    ]
    assert evaluate(paths.case_folder(C), c=["/a/case_1/x", "/a/b/x", "x"]) == ["case_1", None, None]


def test_numbers(evaluate):
    texts = [" 5 ", "1_0", "1d", "1,5", "-inf", "+Infinity", "1.", ".5", "1e3", "", "1__0", "- 1", None]
    got = evaluate(fields.parse_number(C), c=texts)

    def py(t):
        try:
            return float(t)
        except (TypeError, ValueError):
            return None

    assert got == [py(t) for t in texts]
    assert str(evaluate(fields.parse_number(C), c=["NaN"])[0]) == "nan"


def test_invoice_fields(evaluate):
    f = fields.invoice_fields(el.document_elements(C))
    last = ["", "", "", "", "Total", "1234.50", "eur"]
    docs = [
        document(table(["1"], last)),
        document(table(last[:5] + ["1,234.50", "eur"])),
        document(table(last[:6])),
        document({"type": "text", "content": "x"}),
        document(table(last), {"type": "table", "content": "  "}),
        document(table(last), table(["other"])),
        "{}",
        "not json",
    ]
    got = [tuple(r) for r in evaluate(f, c=docs)]
    none = (None, None)
    assert got == [(1234.5, "EUR"), none, none, none, (1234.5, "EUR"), none, none, none]
    assert tuple(evaluate(fields.invoice_fields(el.document_elements(C), 10, 1), c=docs)[0]) == none


def test_declaration_fields(evaluate):
    head = ["Item", "Base", "Amount", "Cur"]
    f = fields.declaration_fields(el.document_elements(C))
    rows = (["Invoice", "", "100", "eur"], ["Tax A", "", "5", "eur"], ["VAT", "", "21", "eur"])
    docs = [
        document(table(head, *rows, ["Total", "", "126", "eur"])),
        document(table(head, ["Total invoice", "", "7", ""], ["Tax amount", "", "8", ""])),
        document(table(head, ["VAT", "", "1"], ["VAT", "", "2"], ["short", "1"])),
        document(table(head, ["Total", "", "1,0", "usd"])),
        document(table(head)),
    ]
    got = [r.asDict() for r in evaluate(f, c=docs)]
    assert got[0] == {
        "declaration_invoice_total": 100.0, "declaration_tax_A": 5.0, "declaration_tax_B": None,
        "declaration_VAT": 21.0, "declaration_royalty": None, "declaration_total": 126.0,
        "declaration_currency": "EUR", "bad_amounts": [],
    }
    assert (got[1]["declaration_invoice_total"], got[1]["declaration_tax_A"]) == (7.0, 8.0)
    assert got[1]["declaration_total"] is None and got[1]["declaration_currency"] is None
    assert got[2]["declaration_VAT"] == 2.0 and got[2]["declaration_currency"] is None
    assert got[3]["declaration_total"] is None and got[3]["bad_amounts"] == ["1,0"]
    assert got[4]["declaration_currency"] == "CUR"


def test_royalty(evaluate):
    texts = ["5%", "7,5 %", "1.000,5%", "rate 3.5 % or 9%", "12,%", "none"]
    docs = [document({"type": "page_footer", "content": t}) for t in texts]
    got = evaluate(fields.royalty_percentage(el.document_elements(C)), c=docs)
    assert got == [5.0, 7.5, 0.5, 3.5, None, None]


def test_metadata_reads_only_the_fields_of_the_role(evaluate):
    doc = document(table(["", "", "5%", "eur", "", "9.5", "usd"]))
    m = fields.structured_metadata(F.col("p"), el.document_elements(C))
    names = ["/c/INVOICE_1.pdf", "/c/royalty_1.pdf", "/c/other.pdf"]
    got = [r.asDict() for r in evaluate(m, c=[doc] * 3, p=names)]
    filled = [{k: v for k, v in g.items() if v not in (None, [])} for g in got]
    assert filled == [
        {"invoice_total": 9.5, "invoice_currency": "USD"}, {"royalty_percentage": 5.0}, {},
    ]


def test_chunks_and_payload(evaluate):
    doc = json.dumps({"document": {"elements": [
        {"id": 3, "type": "text", "content": " a "},
        {"type": "table", "content": "<table>"},
        {"id": "f", "type": "footer", "content": "x"},
        {"id": "e", "type": "text", "content": ""},
        {"id": "n", "type": "text", "content": None},
        {"id": "b", "type": "section_header", "content": "  "},
    ]}})
    chunks = evaluate(el.content_chunks(el.document_elements(C)), c=[doc, "{}", ""])
    assert [[tuple(c) for c in cs] for cs in chunks] == [
        [("3", " a "), ("", "<table>"), ("b", "  ")], [], [],
    ]
    payload = evaluate(el.translation_payload(el.document_elements(C)), c=[doc, "{}"])
    assert json.loads(payload[0]) == [
        {"idx": 0, "type": "text", "content": "a"}, {"idx": 1, "type": "table", "content": "<table>"},
    ]
    assert payload[1] is None


def test_recover_json(evaluate):
    replies = [
        '{"a":1}', '```json\n{"a":1}\n```', 'text {"a":1} more', '[{"a":1}]', "[1]", "x", "", None,
        '```\nnope\n``` then ```JSON {"b": {"c": 2}} ```', '{"a": ',
    ]
    got = evaluate(el.recover_json_object(C), c=replies)
    assert [g and json.loads(g) for g in got] == [
        {"a": 1}, {"a": 1}, {"a": 1}, {"a": 1}, None, None, None, None, {"b": {"c": 2}}, None,
    ]


def test_translation_outcome(evaluate):
    original = json.dumps({"document": {"elements": [
        {"id": 1, "type": "text", "content": "hola", "box": [1, 2.5]}, {"type": "x", "content": "y"},
    ], "pages": 2}, "meta": {"k": None}})
    replies = [
        "sorry", '{"source_language":"EN","items":[]}', '{"items":[{"idx":0,"content":"x"}]}',
        '{"source_language":" es ","items":[{"idx":"q","content":"x"},{"idx":0}]}',
        '{"source_language":"es","items":[{"idx":0,"content":"a"},{"idx":"0","content":" hello "},'
        '{"idx":9,"content":"z"}]}',
    ]
    got = evaluate(
        el.translation_outcome(F.col("d"), C), c=replies, d=[original] * len(replies)
    )
    assert [(g["source_language"], g["applied"]) for g in got] == [
        ("en", False), ("en", False), ("en", False), ("es", False), ("es", True),
    ]
    assert all(g["content"] == original for g in got[:4])
    expected = json.loads(original)
    expected["document"]["elements"][0]["content"] = "hello"
    assert json.loads(got[4]["content"]) == expected  # every other field is untouched


def test_rows_and_cells_end_at_the_first_closing_tag(evaluate):
    texts = [
        "<TR a='1'><td>x<b>y</b></TD><th >z</th></tR><tr></tr>", "<tr><td>open<tr>more</td></tr> <tr>no end",
        "<tr>" + "<" * 20_000 + "</tr>", "<track>no</track><tr\n><td>a\n</td>b</tr>", "</tr><tr></td></tr>", "<tr", "",
    ]
    for made, name in ((html.raw_rows, "tr"), (html.raw_cells, "t[dh]")):
        lazy = re.compile(rf"<{name}\b[^>]*>(.*?)</{name}>", re.I | re.S)
        assert evaluate(made(C), c=texts) == [lazy.findall(t) for t in texts]


def test_blanks_around_a_table_do_not_count(evaluate):
    def read(content):
        return document({"type": "table", "content": "<table><tr><td>1</td></tr></table>"}, {"type": "table", "content": content})

    cells = html.table_cells(el.last_table(el.document_elements(C)))
    texts = [read(t) for t in ("\u3000\x1c <tr><td>2</td></tr>\n", " \u2028\x1f\u00a0", "")]
    assert evaluate(cells, c=texts) == [[["2"]], [["1"]], [["1"]]]
