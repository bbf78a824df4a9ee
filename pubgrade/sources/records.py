"""Nested dumps into flat records: XML records and bibliographic JSON files."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pubgrade.sources.ingest import DAMAGED, read_json_files

# fixed values: element names of the person records
PERSON_RECORD = """
`person:person` struct<
  `person:name`: struct<
    `personal-details:given-names`: string,
    `personal-details:family-name`: string,
    `personal-details:credit-name`: string>,
  `other-name:other-names`: struct<`other-name:other-name`: array<struct<`other-name:content`: string>>>,
  `address:addresses`: struct<`address:address`: array<struct<`address:country`: string>>>>,
`activities:activities-summary` struct<
  `activities:employments`: struct<
    `activities:affiliation-group`: array<struct<
      `employment:employment-summary`: array<struct<
        `common:role-title`: string,
        `common:start-date`: struct<`common:year`: string>,
        `common:end-date`: struct<`common:year`: string>,
        `common:organization`: struct<
          `common:name`: string,
          `common:disambiguated-organization`: struct<
            `common:disambiguated-organization-identifier`: string,
            `common:disambiguation-source`: string>>>>>>>>
"""

# fixed values: element names of the work records
WORK_RECORD = """
`work:title` struct<`common:title`: string, `common:subtitle`: string>,
`work:journal-title` string,
`work:short-description` string,
`work:citation` struct<`work:citation-type`: string, `work:citation-value`: string>,
`work:type` string,
`common:publication-date` struct<`common:year`: string, `common:month`: string, `common:day`: string>,
`common:url` string,
`common:external-ids` struct<`common:external-id`: array<struct<
  `common:external-id-type`: string,
  `common:external-id-value`: string,
  `common:external-id-normalized`: string>>>,
`work:contributors` struct<`work:contributor`: array<struct<
  `common:contributor-orcid`: struct<`common:path`: string>,
  `work:credit-name`: string,
  `work:contributor-attributes`: struct<`work:contributor-role`: string>>>>
"""

# fixed values: element names of the legal entity records
LEGAL_ENTITY = "`lei:LEI` string, `lei:Entity` struct<`lei:LegalName`: string>"

# fixed values: keys of the bibliographic items
ITEM = """struct<
DOI: string, type: string, title: array<string>, subtitle: array<string>, abstract: string,
ISBN: array<string>, ISSN: array<string>, URL: string,
author: array<struct<given: string, family: string, ORCID: string>>,
published: struct<`date-parts`: array<array<int>>>>"""

_XML = {"ignoreSurroundingSpaces": "false"}


def read_members(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row (path, xml) per file; many small files share a task."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml")
    )


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with a costly value as ``name``, computed once per row.

    The filters and columns that use it would each repeat a plain column's expression;
    they cannot move below a generator of one row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_records(members: DataFrame, record: str, damaged: str = "drop") -> DataFrame:
    """``members`` with the parsed record as ``r``.

    Records that are no complete XML are left out ("drop"), are all that is returned,
    as they came ("only"), or raise ("fail"). Every record is parsed once, whatever is
    asked of ``r`` afterwards.
    """
    if damaged not in ("drop", "only", "fail"):
        raise ValueError(f"damaged must be drop, only or fail, not {damaged}")
    options = _XML | {"columnNameOfCorruptRecord": DAMAGED, "mode": "FAILFAST" if damaged == "fail" else "PERMISSIVE"}
    parsed = _once(members, F.from_xml("xml", f"{record.rstrip()}, `{DAMAGED}` string", options), "r")
    broken = F.col("r").isNull() | F.col(f"r.{DAMAGED}").isNotNull()
    return parsed.where(broken).select(members.columns) if damaged == "only" else parsed.where(~broken)


def _one_or_list(values: Column) -> Column:
    """A single value as it is, several as the JSON text of their list."""
    present = F.filter(values, lambda value: value.isNotNull() & (value != ""))
    return F.when(F.size(present) == 1, F.get(present, F.lit(0))).when(F.size(present) > 1, F.to_json(present))


def _file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def record_id(path: Column) -> Column:
    """Id of a person from the name of the file: everything before the first dot."""
    return F.substring_index(_file_name(path), ".", 1)


def publication_id(path: Column) -> Column:
    """Id of a work: what follows the last ``_works_`` in the file name."""
    return F.substring_index(record_id(path), "_works_", -1)


def owner_id(path: Column) -> Column:
    """Id of the person a work belongs to: everything before the first underscore."""
    return F.substring_index(_file_name(path), "_", 1)


def extract_persons(members: DataFrame, damaged: str = "drop") -> DataFrame:
    """(path, xml) -> persons whose affiliations still carry the organisation; see ``parse_records`` for ``damaged``."""
    record = parse_records(members, PERSON_RECORD, damaged)
    if damaged == "only":
        return record
    record = record.select("path", "r")
    person = F.col("r.`person:person`")
    name = person["person:name"]
    groups = F.col("r.`activities:activities-summary`.`activities:employments`.`activities:affiliation-group`")

    def affiliation(job: Column) -> Column:
        organisation = job["common:organization"]
        identified = organisation["common:disambiguated-organization"]
        return F.struct(
            job["common:start-date"]["common:year"].alias("startYear"),
            job["common:end-date"]["common:year"].alias("endYear"),
            job["common:role-title"].alias("role"),
            organisation["common:name"].alias("orgName"),
            identified["common:disambiguated-organization-identifier"].alias("orgID"),
            identified["common:disambiguation-source"].alias("orgIDType"),
        )

    def has_content(a: Column) -> Column:
        return F.coalesce(*[a[f] for f in ("startYear", "endYear", "role", "orgName", "orgID", "orgIDType")]).isNotNull()

    jobs = F.flatten(F.transform(groups, lambda group: group["employment:employment-summary"]))
    affiliations = F.filter(F.transform(jobs, affiliation), has_content)
    return record.select(
        record_id(F.col("path")).alias("id"),
        name["personal-details:given-names"].alias("firstName"),
        name["personal-details:family-name"].alias("lastName"),
        name["personal-details:credit-name"].alias("publishedName"),
        _one_or_list(person["other-name:other-names"]["other-name:other-name"]["other-name:content"]).alias("otherNames"),
        _one_or_list(person["address:addresses"]["address:address"]["address:country"]).alias("country"),
        F.when(F.size(affiliations) > 0, affiliations).alias("affiliations"),
    )


def extract_work_records(members: DataFrame, damaged: str = "drop") -> DataFrame:
    """(path, xml) -> nested works, the input of ``operators.extract.flatten_works``; see ``parse_records`` for ``damaged``."""
    record = parse_records(members, WORK_RECORD, damaged)
    if damaged == "only":
        return record
    record = record.select("path", "r")

    def contributor(c: Column) -> Column:
        return F.struct(
            c["work:credit-name"].alias("credit_name"),
            c["work:contributor-attributes"]["work:contributor-role"].alias("role"),
            c["common:contributor-orcid"]["common:path"].alias("orcid"),
        )

    def external_id(i: Column) -> Column:
        return F.struct(
            i["common:external-id-type"].alias("type"),
            i["common:external-id-value"].alias("value"),
            i["common:external-id-normalized"].alias("normalized"),
        )

    date, source = F.col("r.`common:publication-date`"), F.col("r.`work:citation`")
    return record.select(
        "path",
        F.col("r.`work:title`.`common:title`").alias("title"),
        F.col("r.`work:title`.`common:subtitle`").alias("subTitle"),
        F.col("r.`work:journal-title`").alias("journal_title"),
        F.col("r.`work:short-description`").alias("abstract"),
        F.col("r.`work:type`").alias("type"),
        F.col("r.`common:url`").alias("url"),
        F.struct(
            date["common:year"].alias("year"), date["common:month"].alias("month"), date["common:day"].alias("day")
        ).alias("publication_date"),
        F.struct(
            source["work:citation-type"].alias("type"), source["work:citation-value"].alias("value")
        ).alias("citation"),
        F.transform(F.col("r.`work:contributors`.`work:contributor`"), contributor).alias("contributors"),
        F.transform(F.col("r.`common:external-ids`.`common:external-id`"), external_id).alias("external_ids"),
    )


def read_xml_records(spark: SparkSession, paths: str | list[str], tag: str) -> DataFrame:
    """One row (xml) per element of a tag in large XML files.

    The end tag serves as the separator of a text source, which Spark can split;
    the XML source reads a whole file in one task.
    """
    parts = spark.read.option("lineSep", f"</{tag}>").text(paths)
    start = F.regexp_extract("value", rf"(?s)<{tag}[\s>].*", 0)
    return parts.select(start.alias("start")).where("start <> ''").select(F.concat("start", F.lit(f"</{tag}>")).alias("xml"))


def read_legal_entities(spark: SparkSession, paths: str | list[str], damaged: str = "drop") -> DataFrame:
    """(id, name) of every legal entity, or (xml) of the damaged ones."""
    records = parse_records(read_xml_records(spark, paths, "lei:LEIRecord"), LEGAL_ENTITY, damaged)
    if damaged == "only":
        return records
    return records.select(F.col("r.`lei:LEI`").alias("id"), F.col("r.`lei:Entity`.`lei:LegalName`").alias("name"))


def read_items(spark: SparkSession, paths: str | list[str], damaged: str = "drop") -> DataFrame:
    """One row per item of bibliographic JSON files, each file one task's work at most.

    Of damaged files nothing is read; ``damaged="only"`` gives their texts.
    """
    schema = T.StructType.fromDDL(f"items array<{ITEM}>")
    files = read_json_files(spark, paths, schema, damaged)
    return files if damaged == "only" else files.select(F.inline("items"))


def _braces(segments: Column, inside: int) -> Column:
    """Opening braces in every second segment between quotation marks, from segment ``inside`` on."""
    counts = F.transform(segments, lambda s, i: F.when(i % 2 == inside, F.length(s) - F.length(F.replace(s, F.lit("{"), F.lit("")))).otherwise(0))
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def _running(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """``pieces`` with the sum of ``value`` over all earlier pieces of the file as ``name``.

    Sums within a block of the file first, and one row per block for what comes before it.
    """
    blocks = pieces.groupBy("file", "block").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    summed = pieces.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0))).join(before, ["file", "block"])
    return summed.withColumn(name, F.col("_own") + F.col("_before")).drop("_own", "_before")


def split_items(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The text of every object of the array ``items`` of bibliographic JSON files, as (json).

    A file of any size is read by many tasks: closing braces separate the pieces that
    a text source splits it into. Quotation marks before a piece tell whether it begins inside a
    string, braces before it how deep; an item ends where the depth comes back to one, and the
    pieces of an item, also from both sides of a block's border, are joined again. Other fields of a file
    may stand before or after the items, but no other array of objects.
    """
    pieces = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    segments = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')
    pieces = pieces.withColumn("_s", segments).select(
        "file", "block", "at", "text", (F.size("_s") - 1).alias("marks"), _braces(F.col("_s"), 0).alias("outer"), _braces(F.col("_s"), 1).alias("inner")
    )
    pieces = _running(pieces, "marks", "marks_before")
    begins_inside, ends_inside = F.col("marks_before") % 2 == 1, (F.col("marks_before") + F.col("marks")) % 2 == 1
    closes = F.when(ends_inside, 0).otherwise(1)
    pieces = pieces.withColumns({"closes": closes, "change": F.when(begins_inside, F.col("inner")).otherwise(F.col("outer")) - closes})
    pieces = _running(pieces, "change", "depth")
    pieces = pieces.withColumn("ends", ((F.col("closes") == 1) & (F.col("depth") + F.col("change") == 1)).cast("int"))
    pieces = _running(pieces, "ends", "item").withColumn("piece", F.struct("block", "at", "text", "depth", "ends"))
    items = pieces.groupBy("file", "item").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    # what follows the last item has no end
    items = items.where(F.element_at("pieces", -1)["ends"] == 1)
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["text"]), "}"), F.lit("}"))
    items = items.select(text.alias("text"), (F.get("pieces", F.lit(0))["depth"] == 0).alias("first"))
    opened = r'"items"\s*:\s*\[\s*'
    lead = F.when(F.col("first"), rf"(?s)^\s*\{{.*?{opened}(?=\{{)").otherwise(rf"^(?:\s*,\s*|[^{{]*{opened})(?=\{{)")
    return items.where(F.regexp_like("text", lead)).select(F.regexp_replace("text", lead, F.lit("")).alias("json"))


def read_large_items(spark: SparkSession, paths: str | list[str], damaged: str = "drop") -> DataFrame:
    """Like ``read_items`` for files of any size, each read by many tasks; items that cannot be parsed, or are cut off at the end, are damaged one by one."""
    if damaged not in ("drop", "only", "fail"):
        raise ValueError(f"damaged must be drop, only or fail, not {damaged}")
    schema = T.StructType([*T.StructType.fromDDL(f"i {ITEM}")["i"].dataType, T.StructField(DAMAGED, T.StringType())])
    options = {"columnNameOfCorruptRecord": DAMAGED, "mode": "FAILFAST" if damaged == "fail" else "PERMISSIVE"}
    parsed = _once(split_items(spark, paths), F.from_json("json", schema, options), "i")
    broken = F.col("i").isNull() | F.col(f"i.{DAMAGED}").isNotNull()
    return parsed.where(broken).select("json") if damaged == "only" else parsed.where(~broken).select("i.*").drop(DAMAGED)


def flatten_items(items: DataFrame) -> DataFrame:
    """Bibliographic items -> rows of the reference table."""
    doi = F.col("DOI")

    def author(a: Column, position: Column) -> Column:
        own_id = F.concat(doi, F.lit("_"), position.cast("string"))
        return F.struct(
            a["given"].alias("firstName"),
            F.coalesce(F.substring_index(a["ORCID"], "/", -1), own_id).alias("id"),
            a["family"].alias("lastName"),
        )

    parts = F.get(F.col("published.`date-parts`"), F.lit(0))
    date = F.array_join(F.transform(parts, lambda part: part.cast("string")), "-")
    return items.select(
        "abstract",
        F.when(F.size("author") > 0, F.transform("author", author)).alias("authors"),
        F.nullif(date, F.lit("")).alias("date"),
        doi.alias("doi"),
        F.get("ISBN", F.lit(0)).alias("isbn"),
        F.get("ISSN", F.lit(0)).alias("issn"),
        F.get("subtitle", F.lit(0)).alias("subTitle"),
        F.get("title", F.lit(0)).alias("title"),
        "type",
        F.col("URL").alias("url"),
    )
