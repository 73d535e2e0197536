from __future__ import annotations

from studygraph.sources import catalogue

TEXT = """# a catalogue
---
Activity:
  NCI C-Code: C71473
  Preferred Term: 'Activity''s term'
  Definition: An action: undertaking
    or event.
  Modifier: Concrete
  Super Classes:
  - $ref: "#/SyntaxTemplate"
  - $ref: '#/Base'
  Attributes:
    id:
      Cardinality: '1'
      Type:
      - $ref: '#/string'
      - $ref: '#/Other'
    childIds:
      Cardinality: 0..*
      Relationship Type: Ref
      Type:
        - $ref: '#/Activity'
      Inherited From:
        - $ref: '#/SyntaxTemplate'
      Definition: >-
        Refers: to others,
        over lines
      NCI C-Code: C1
      Model Name: "children \\"x\\""
    bare:
Empty:
  Modifier: Abstract
  Attributes:
"Quoted Name":
  Modifier: Abstract
  Attributes:
    note:
      Cardinality: 1..*   # many
      Preferred Term: ~
"""


def test_attributes(spark):
    frame = spark.createDataFrame([("a", TEXT, 1), ("b", TEXT.replace("\n", "\r\n"), 1), ("c", None, 1), ("d", "", 1), ("e", "just text\n- item", 1)], "file string, text string, pos int")
    rows = catalogue.attributes(frame).collect()
    want = {
        ("Activity", "id", "#/string", "1", True, False, "Value", None, None, None, None, "Concrete", "C71473", ("SyntaxTemplate", "Base")),
        ("Activity", "childIds", "#/Activity", "0..*", False, True, "Ref", "C1", "Refers: to others, over lines", 'children "x"', "SyntaxTemplate", "Concrete", "C71473", ("SyntaxTemplate", "Base")),
        ("Activity", "bare", "#/string", "0..1", False, False, "Value", None, None, None, None, "Concrete", "C71473", ("SyntaxTemplate", "Base")),
        ("Quoted Name", "note", "#/string", "1..*", True, True, "Value", None, None, None, None, "Abstract", None, ()),
    }
    got = [(r["file"], (r["entity"], r["attribute"], r["type_ref"], r["cardinality"], r["required"], r["is_list"], r["relationship"], r["nci_code"], r["definition"], r["model_name"], r["inherited_from"], r["modifier"], r["entity_code"], tuple(r["super_classes"]))) for r in rows]
    assert {x for f, x in got if f == "a"} == want and {x for f, x in got if f == "b"} == want and len(got) == 8
    assert all(r["preferred_term"] is None for r in rows)
    assert catalogue.attributes(frame.limit(0)).count() == 0


def test_files_and_issues(spark, tmp_path):
    (tmp_path / "one.yml").write_text(TEXT)
    rules = catalogue.read_catalogues(spark, str(tmp_path))
    assert rules.count() == 4
    entities = spark.createDataFrame(
        [("Activity", 1, {"id": '"a"', "childIds": '["x"]'}, ""), ("Activity", 2, {"id": "null", "childIds": '"x"', "odd": "1"}, ""), ("Activity", 3, {}, ""), ("Activity", 4, None, ""), ("Activity", 5, {"id": '["a"]', "bare": "[]"}, ""), ("Unknown", 6, {}, ""), (None, 7, {}, ""), ("Quoted Name", 8, {"note": " [] "}, "")],
        "entity string, id int, fields map<string, string>, attribute string",
    )
    got = sorted(tuple(r)[1:] for r in catalogue.catalogue_issues(entities, rules).collect())
    assert got == [(2, "childIds", "list expected"), (2, "id", "required"), (2, "odd", "unknown"), (3, "id", "required"), (4, "id", "required"), (5, "id", "single value expected"), (8, "note", "required")]
    assert catalogue.catalogue_issues(entities, rules.limit(0)).count() == 0
