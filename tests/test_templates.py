"""Post templates: what they render, and what is refused when they are parsed."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from sparkevents.operators import bundles, templates

EVENTS = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, ""), ("b", 1, '{"k": "{{"}')]


def bodies(spark, template, **options):
    df = spark.createDataFrame(EVENTS, "name string, id long, value string")
    found = bundles.http_payload(df, ["name"], "id", post_template=template, **options)
    return dict(rows(found, "name", "payload"))


@pytest.mark.parametrize(
    ("template", "expected"),
    [
        ("{{range .Events}}{{.EventText}}{{end}}", "x\n, y"),
        ("[{{.FileName}}|{{ .FileSize }}]", "[a|4]"),
        ("{{range .Events}}<{{.EventSeq}}>{{end}}{{range .Events}}again{{else}} nothing left{{end}}", "<0><1> nothing left"),
        ("{{range .Events}}{{if .EventSeq}}+{{else}}{{$.FileName}}:{{end}}{{end}}", "a:+"),
        ("  {{- /* a\ncomment */ -}}  one {{- `two` -}}\n three{{\"\\t\\u00e9\"}}", "onetwothree\té"),
        ("{{if .FileSize}}yes{{end}}{{if ``}}no{{else}}{{if .FileName}}in{{end}}{{end}}", "yesin"),
        ("{{if `0`}}a text{{end}}{{`}}`}}", "a text}}"),
        ("plain { } text", "plain { } text"),
        ("", ""),
    ],
)
def test_templates(spark, template, expected):
    assert bodies(spark, template)["a"] == expected


def test_events_of_a_template(spark):
    template = "{{range .Events}}{{.EventText}}{{end}}"
    assert bodies(spark, template)["b"] == '{"k": "{{"}'
    assert bodies(spark, template, leef=True)["a"] == "x\ny\n"
    assert bodies(spark, template, comma_separate=False)["a"] == "x\ny\n"
    assert bodies(spark, template, as_base64=True)["a"] == "eA==CiwgeQ=="


@pytest.mark.parametrize(
    "template",
    [
        "{{.Nothing}}", "{{.EventText}}", "{{range .Events}}{{.FileName}}{{end}}", "{{range .Events}}", "{{end}}", "{{else}}",
        "{{if .FileName}}a{{else}}b{{else}}c{{end}}", "{{range .FileName}}{{end}}", "{{.FileName", "{{printf `x`}}", "{{}}",
        "{{range .Events}}{{range $.Events}}{{end}}{{end}}", "{{if .FileName}}{{range .Events}}{{end}}{{end}}", "a {{ b",
    ],
)
def test_refused_templates(template):
    with pytest.raises(ValueError):
        templates.parse(template)


def test_no_events(spark):
    nodes = templates.parse("{{range .Events}}e{{else}}none of {{.FileName}}{{end}}")
    none = F.array().cast("array<struct<event_seq:bigint,text:string>>")
    body = templates.compiled(nodes, none, FileName=F.lit("f"), FileSize=F.lit(0))
    assert spark.range(1).select(body).first()[0] == "none of f"
