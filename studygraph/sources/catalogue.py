"""Schema catalogues in YAML as attribute rows, and the rules that they state, applied to entities.

A catalogue file has entities at its margin; below an entity its own fields and `Attributes`, below that the attributes,
below those their properties. Steps are of two spaces. Only Spark reads the files, so they can lie in any store it knows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_KEY = r"""^(?:- )?("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s"'#\-&*!|>%@`{}\[\]][^#]*?)\s*:(?:\s+(.*))?$"""
#: Cardinalities that make an attribute required, and those of lists.
REQUIRED, LISTS = ("1", "1..*"), ("0..*", "1..*")


def scalar(text: Column) -> Column:
    """The text of a YAML scalar: quotes go, with their escapes, and so does a comment behind an unquoted one; null, ~ and
    nothing are null."""
    t = F.trim(text)
    single = F.replace(F.regexp_extract(t, r"^'((?:[^']|'')*)'", 1), F.lit("''"), F.lit("'"))
    double = F.from_json(F.concat(F.lit('{"x":'), F.regexp_extract(t, r'^("(?:[^"\\]|\\.)*")', 1), F.lit("}")), "x string")["x"]
    plain = F.regexp_replace(t, r"\s+#.*$", "")
    return F.when(F.startswith(t, F.lit("'")), single).when(F.startswith(t, F.lit('"')), double).when(plain.isin("", "~", "null") | F.startswith(plain, F.lit("#")), None).otherwise(plain)


def catalogue_lines(texts: DataFrame, file: str, text: str) -> DataFrame:
    """(file, pos, indent, key, value, entity_no, entity, section, attribute, property) of every line that says something:
    each line with the names of the lines that it is below, the nearest of each depth."""
    lines = texts.select(F.col(file).alias("file"), F.posexplode(F.split(text, r"\r?\n")).alias("pos", "line")).filter(~F.col("line").rlike(r"^\s*(?:#.*|---.*|\.\.\.|)$"))
    told = lines.withColumn("indent", F.length("line") - F.length(F.ltrim("line"))).withColumn("body", F.trim("line"))
    keyed = told.withColumn("key", F.when(F.col("body").rlike(_KEY), scalar(F.regexp_extract("body", _KEY, 1)))).withColumn("value", F.when(F.col("key").isNotNull(), F.regexp_extract("body", _KEY, 2)).otherwise(F.col("body")))
    keyed = keyed.withColumn("item", F.startswith("body", F.lit("- ")))
    before = Window.partitionBy("file").orderBy("pos")  # a file is one catalogue, written by people
    named = keyed.withColumn("entity_no", F.sum(F.when((F.col("indent") == 0) & F.col("key").isNotNull() & ~F.col("item"), 1).otherwise(0)).over(before))
    inside = Window.partitionBy("file", "entity_no").orderBy("pos")
    section_no = F.sum(F.when((F.col("indent") == 2) & F.col("key").isNotNull() & ~F.col("item"), 1).otherwise(0)).over(inside)
    named = named.withColumn("entity", F.first("key").over(inside)).withColumn("section_no", section_no)
    within = Window.partitionBy("file", "entity_no", "section_no").orderBy("pos")
    attribute_no = F.sum(F.when((F.col("indent") == 4) & F.col("key").isNotNull() & ~F.col("item"), 1).otherwise(0)).over(within)
    named = named.withColumn("section", F.when(F.col("section_no") > 0, F.first("key").over(within))).withColumn("attribute_no", F.when(F.col("section") == "Attributes", attribute_no).otherwise(0))
    deepest = Window.partitionBy("file", "entity_no", "section_no", "attribute_no").orderBy("pos")
    own = F.when((F.col("indent") == 6) & F.col("key").isNotNull() & ~F.col("item"), F.col("key"))
    attribute = F.when(F.col("attribute_no") > 0, F.first("key").over(deepest))
    return named.withColumn("attribute", attribute).withColumn("property", F.when(F.col("attribute_no") > 0, F.last(own, True).over(deepest)).otherwise(F.col("section"))).drop("line", "body")


def attributes(texts: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, entity, modifier, entity_code, super_classes, attribute, type_ref, cardinality, required, is_list,
    relationship, nci_code, preferred_term, definition, model_name, inherited_from) of each attribute in catalogue texts.

    Left out properties have the defaults of the format: type "#/string", cardinality "0..1", relationship "Value", modifier
    "Concrete"; of a list of references the first counts. A definition may run over several lines. An entity without
    attributes gives no row, one whose attribute has no properties a row of defaults. Null and empty texts give none."""
    lines = catalogue_lines(texts, file, text).filter("entity_no > 0")
    inline = lines.withColumn("value", scalar(F.col("value")))
    own, deep = F.col("attribute_no") == 0, F.col("indent") == 6

    def entity_field(name: str) -> Column:
        return F.min_by(F.when(own & (F.col("indent") == 2) & (F.col("key") == name), F.col("value")), F.when(own & (F.col("indent") == 2) & (F.col("key") == name), F.col("pos")))

    refs = F.array_sort(F.collect_list(F.when((F.col("section") == "Super Classes") & (F.col("key") == "$ref"), F.struct("pos", F.replace("value", F.lit("#/"), F.lit("")).alias("ref")))))
    entities = inline.groupBy("file", "entity_no").agg(F.any_value("entity").alias("entity"), F.coalesce(entity_field("Modifier"), F.lit("Concrete")).alias("modifier"), entity_field("NCI C-Code").alias("entity_code"), F.transform(refs, lambda x: x["ref"]).alias("super_classes"))

    def prop(name: str) -> Column:
        here = deep & (F.col("key") == name) & ~F.col("item")
        return F.min_by(F.when(here, F.col("value")), F.when(here, F.col("pos")))

    def ref(name: str) -> Column:
        here = (F.col("property") == name) & (F.col("key") == "$ref")
        return F.min_by(F.when(here, F.col("value")), F.when(here, F.col("pos")))

    more = F.array_sort(F.collect_list(F.when((F.col("property") == "Definition") & (F.col("indent") > 4), F.struct("pos", F.trim(F.regexp_replace(F.when(deep & (F.col("key") == "Definition"), F.col("value")).otherwise(F.col("raw")), r"^[|>]-?$", "")).alias("t")))))
    definition = F.nullif(F.trim(F.array_join(F.transform(more, lambda x: x["t"]), " ")), F.lit(""))
    raw = inline.withColumn("raw", F.when(F.col("key").isNotNull(), F.concat_ws(": ", "key", "value")).otherwise(F.col("value")))
    found = raw.filter("attribute_no > 0").groupBy("file", "entity_no", "attribute_no").agg(
        F.any_value("attribute").alias("attribute"), F.coalesce(ref("Type"), F.lit("#/string")).alias("type_ref"), F.coalesce(prop("Cardinality"), F.lit("0..1")).alias("cardinality"), F.coalesce(prop("Relationship Type"), F.lit("Value")).alias("relationship"),
        prop("NCI C-Code").alias("nci_code"), prop("Preferred Term").alias("preferred_term"), definition.alias("definition"), prop("Model Name").alias("model_name"), F.replace(ref("Inherited From"), F.lit("#/"), F.lit("")).alias("inherited_from"),
    )
    required, is_list = F.col("cardinality").isin(*REQUIRED), F.col("cardinality").isin(*LISTS)
    return found.join(entities, ["file", "entity_no"]).select(
        "file", "entity", "modifier", "entity_code", "super_classes", "attribute", "type_ref", "cardinality", required.alias("required"), is_list.alias("is_list"), "relationship", "nci_code", "preferred_term", "definition", "model_name", "inherited_from"
    )


def read_catalogues(spark: SparkSession, path: str) -> DataFrame:
    """attributes() of every file under a path."""
    return attributes(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text")))


def catalogue_issues(entities: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(entity, id, attribute, issue) where entities (entity, id, fields as a map of JSON texts) break a catalogue: "required"
    where a required attribute is missing, null or an empty list, "list expected" where one that holds many is no list,
    "single value expected" where one that holds one is a list, "unknown" for a field that the entity's catalogue lacks.
    Entities that no catalogue names give none. The rules are rows that are joined, so a catalogue read at run time applies as
    it is; of an attribute that several files state, the strictest counts."""
    rules = catalogue.groupBy("entity", "attribute").agg(F.bool_or("required").alias("required"), F.bool_and("is_list").alias("is_list"))
    whole = rules.groupBy("entity").agg(F.collect_list(F.struct("attribute", "required", "is_list")).alias("rules"))  # the attributes of one entity
    held = entities.join(whole, "entity")
    value = lambda r: F.trim(F.try_element_at("fields", r["attribute"]))
    missing = lambda r: value(r).isNull() | value(r).isin("null", "[]", '""', "")
    is_list = lambda r: F.startswith(value(r), F.lit("["))
    issue = lambda r: F.when(missing(r), F.when(r["required"], "required")).when(r["is_list"] & ~is_list(r), "list expected").when(~r["is_list"] & is_list(r), "single value expected")
    broken = F.filter(F.transform("rules", lambda r: F.struct(r["attribute"].alias("attribute"), issue(r).alias("issue"))), lambda x: x["issue"].isNotNull())
    known = F.transform("rules", lambda r: r["attribute"])
    unknown = F.transform(F.array_except(F.map_keys("fields"), known), lambda k: F.struct(k.alias("attribute"), F.lit("unknown").alias("issue")))
    return held.select("entity", "id", F.explode(F.concat(broken, F.coalesce(unknown, F.array().cast("array<struct<attribute: string, issue: string>>")))).alias("x")).select("entity", "id", "x.*")
