"""One query per operator over the dirty views."""

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracles import AS_OF_YEAR
from checks.views import spark_view
from pubgrade import rules, schemas
from pubgrade.functions import text
from pubgrade.operators import correct, enrich, extract, filters, merge, parse, registry, sample
from pubgrade.plans import chain, metrics, monitor, partials, report
from pubgrade.sources import ingest, records, states
from pubgrade.sources.scratch import scratch_path, with_local_scratch

Query = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    chosen = names or tuple(schemas.ENTITIES)
    return {name: spark_view(spark, sf_dir, f"v_{name}").select(_columns(name)) for name in chosen}


def _columns(entity: str) -> list[Column]:
    # the view of the registry with 29 columns has the three that matter
    kept = ["id", "external_ids.GRID.preferred", "name"]
    names = kept if entity == "ROR" else schemas.ENTITIES[entity].names
    return [F.col(f"`{name}`") for name in names]


def flat_works(works: DataFrame) -> DataFrame:
    return works.withColumn("authors", F.array_join("authors", "|"))


def flat_affiliations(persons: DataFrame) -> DataFrame:
    def entry(a: Column) -> Column:
        return F.concat_ws("|", *[F.coalesce(a[f], F.lit("~")) for f in ("role", "orgID", "startYear", "endYear")])

    return persons.withColumn("affiliations", F.array_join(F.transform("affiliations", entry), ";"))


def entity_query(step: Callable[[DataFrame], DataFrame], entity: str, *columns: str) -> Query:
    """A step on one entity; ``columns`` narrow the result."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = step(load(spark, sf_dir, entity)[entity])
        if not columns:
            return flat_works(result) if entity == "works" else flat_affiliations(result)
        if "affiliations" in columns:
            result = flat_affiliations(result)
        return result.select(*columns)

    return query


def view_query(view: str, select: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: select(spark_view(spark, sf_dir, view))


def indicator_query(metric: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        registries = ("ROR", "lei", "fundref") if metric == "CorrectValue" else ()
        entities = load(spark, sf_dir, "works", "persons", "orgUnits", *registries)
        frame = metrics.indicators(entities, [metric], AS_OF_YEAR)
        return frame.select("metric", "indicator", "hits", "base", "value")

    return query


# --- sources and states -------------------------------------------------------------


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    load(spark, sf_dir, "works")["works"].write.json(path, compression="gzip")
    return flat_works(ingest.read_source(spark, path, schemas.WORKS))


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "csv")
    found = []
    for name, columns in {
        "ROR": ("id", "name", "external_ids.GRID.preferred"), "lei": ("id", "name"), "fundref": ("uri", "primary_name_display"),
    }.items():
        view = spark_view(spark, sf_dir, f"v_{name}")
        schema = schemas.ENTITIES[name]
        full = [F.col(f"`{c}`") if c in view.columns else F.lit(None).cast("string").alias(c) for c in schema.names]
        view.select(full).write.option("header", True).csv(f"{root}/{name}.csv")
        read = ingest.read_source(spark, f"{root}/{name}.csv", schema)
        values = [F.col(f"`{c}`") for c in columns] + [F.lit(None).cast("string")] * (3 - len(columns))
        found.append(read.select(F.lit(name).alias("entity"), *[v.alias(a) for v, a in zip(values, ("id", "name", "grid"))]))
    return reduce(DataFrame.unionByName, found)


def state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "states")
    states.write_state(root, states.INITIAL, load(spark, sf_dir, "works"))
    target = chain.run_transformation(spark, root, "CorrectContradict")
    return flat_works(states.read_entity(spark, root, target, "works"))


def ingest_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth line is cut off."""
    path = scratch_path(spark, "damaged")
    line = F.to_json(F.struct("*"))
    cut = F.col("orcid_publication_id").cast("long") % 5 == 0
    works = load(spark, sf_dir, "works")["works"]
    works.select(F.when(cut, F.substring(line, F.lit(1), F.char_length(line) - 3)).otherwise(line).alias("value")).write.text(path)
    good = ingest.read_json(spark, path, schemas.WORKS).select(F.lit("good").alias("kind"), F.col("orcid_publication_id").alias("value"))
    bad = ingest.read_json(spark, path, schemas.WORKS, damaged="only").agg(F.count("*").cast("string").alias("value"))
    return good.unionByName(bad.select(F.lit("damaged").alias("kind"), "value"))


def ingest_one_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "one-entity")
    paths = {}
    for name, df in load(spark, sf_dir, "works", "orgUnits").items():
        paths[name] = f"{root}/in/{name}"
        df.write.json(paths[name])
    ingest.ingest(spark, paths, f"{root}/states", entity="orgUnits")
    found = states.read_entities(spark, f"{root}/states")
    ids = [df.select(F.lit(name).alias("entity"), F.col(df.columns[0]).alias("id")) for name, df in found.items()]
    return reduce(DataFrame.unionByName, ids)


def schema_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "schema")
    persons = load(spark, sf_dir, "persons")["persons"]
    ingest.save_schema(persons, f"{root}/scheme")
    persons.write.json(f"{root}/persons")
    return flat_affiliations(ingest.read_json(spark, f"{root}/persons", ingest.load_schema(spark, f"{root}/scheme")))


def stack_query(stack: str, entity: str) -> Query:
    """An entity after a composed transformation, through stored states."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "stack")
        states.write_state(root, states.INITIAL, load(spark, sf_dir))
        found = states.read_entity(spark, root, chain.run_transformation(spark, root, stack), entity)
        return flat_works(found) if entity == "works" else flat_affiliations(found)

    return query


def state_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "states")
    states.write_state(root, states.INITIAL, load(spark, sf_dir, "works", "persons", "orgUnits"))
    first = chain.run_transformation(spark, root, "FilterObjects")
    second = chain.run_transformation(spark, root, "CorrectContradict", first)
    found = states.read_entities(spark, root, second)
    nothing = F.lit(None).cast("string").alias("isbn")
    return (
        found["works"].select(F.lit("works").alias("entity"), F.col("orcid_publication_id").alias("id"), "isbn")
        .unionByName(found["persons"].select(F.lit("persons").alias("entity"), "id", nothing))
        .unionByName(found["orgUnits"].select(F.lit("orgUnits").alias("entity"), "id", nothing))
    )


def _spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over tasks: a small file holds many rows, and each becomes a long record."""
    return df.hint("rebalance")


def _element(tag: str, value: Column) -> Column:
    """XML element of a value, or nothing for NULL."""
    escaped = F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.coalesce(F.concat(F.lit(f"<{tag}>"), escaped, F.lit(f"</{tag}>")), F.lit(""))


def _nested(tags: str, *content: Column) -> Column:
    opened, closed = "".join(f"<{t}>" for t in tags.split()), "".join(f"</{t}>" for t in reversed(tags.split()))
    return F.concat(F.lit(opened), *content, F.lit(closed))


def person_members(persons: DataFrame) -> DataFrame:
    def job(a: Column) -> Column:
        organisation = _nested(
            "common:organization",
            _element("common:name", a["orgName"]),
            _nested(
                "common:disambiguated-organization",
                _element("common:disambiguated-organization-identifier", a["orgID"]),
                _element("common:disambiguation-source", a["orgIDType"]),
            ),
        )
        start = _nested("common:start-date", _element("common:year", a["startYear"]))
        return _nested(
            "activities:affiliation-group employment:employment-summary", _element("common:role-title", a["role"]), start, organisation
        )

    name = _nested(
        "person:name", _element("personal-details:given-names", F.col("firstName")), _element("personal-details:family-name", F.col("lastName"))
    )
    address = _nested("address:addresses address:address", _element("address:country", F.col("country")))
    jobs = F.array_join(F.transform("affiliations", job), "")
    xml = _nested(
        "record:record", _nested("person:person", name, address), _nested("activities:activities-summary activities:employments", jobs)
    )
    return persons.select(F.concat(F.lit("summaries/"), "id", F.lit(".xml")).alias("path"), xml.alias("xml"))


def extract_xml_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = records.extract_persons(person_members(_spread(spark_view(spark, sf_dir, "v_raw_persons"))))
    jobs = persons.select("id", "firstName", "lastName", "country", F.inline("affiliations"))
    return jobs.select("id", "firstName", "lastName", "country", "startYear", "role", "orgName", "orgID", "orgIDType")


def extract_xml_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every country's person is cut off."""
    persons = _spread(spark_view(spark, sf_dir, "v_raw_persons"))
    members = person_members(persons).withColumn("own", F.col("xml").contains("<address:country>"))
    cut = F.when(F.col("own"), F.substring("xml", F.lit(1), F.char_length("xml") - 30)).otherwise(F.col("xml"))
    members = members.select("path", cut.alias("xml"))
    good = records.extract_persons(members).select(F.lit("good").alias("kind"), "id")
    bad = records.extract_persons(members, damaged="only").select(F.lit("damaged").alias("kind"), records.record_id(F.col("path")).alias("id"))
    return good.unionByName(bad)


def work_members(works: DataFrame) -> DataFrame:
    def contributor(c: Column) -> Column:
        return _nested(
            "work:contributor",
            _nested("common:contributor-orcid", _element("common:path", c["orcid"])),
            _element("work:credit-name", c["credit_name"]),
            _nested("work:contributor-attributes", _element("work:contributor-role", c["role"])),
        )

    def external_id(i: Column) -> Column:
        return _nested(
            "common:external-id",
            _element("common:external-id-type", i["type"]),
            _element("common:external-id-value", i["value"]),
            F.replace(
                _element("common:external-id-normalized", i["normalized"]),
                F.lit("normalized>10"), F.lit('normalized transient="true">10'),
            ),
        )

    date, source = F.col("publication_date"), F.col("citation")
    xml = _nested(
        "work:work",
        _nested("work:title", _element("common:title", F.col("title")), _element("common:subtitle", F.col("subTitle"))),
        _element("work:journal-title", F.col("journal_title")),
        _element("work:short-description", F.col("abstract")),
        _nested("work:citation", _element("work:citation-type", source["type"]), _element("work:citation-value", source["value"])),
        _element("work:type", F.col("type")),
        _nested("common:publication-date", *[_element(f"common:{part}", date[part]) for part in ("year", "month", "day")]),
        _nested("common:external-ids", F.array_join(F.transform("external_ids", external_id), "")),
        _element("common:url", F.col("url")),
        _nested("work:contributors", F.array_join(F.transform("contributors", contributor), "")),
    )
    return works.select("path", xml.alias("xml"))


def extract_xml_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = work_members(_spread(spark_view(spark, sf_dir, "v_raw_works")))
    return flat_works(extract.flatten_works(records.extract_work_records(members)).drop("_authors"))


def read_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items in one file, read in blocks of some kilobytes."""
    path = scratch_path(spark, "items")
    rows = spark_view(spark, sf_dir, "v_raw_items").select(F.explode("items").alias("item"))
    # one line per item in one file; the outer object around them
    lines = rows.select(F.to_json("item").alias("value"), F.monotonically_increasing_id().alias("n"))
    last = lines.agg(F.max("n").alias("last"))
    lines = lines.join(F.broadcast(last)).select(
        F.concat(F.when(F.col("n") == 0, '{"status": "{ok", "items": [').otherwise(""), "value", F.when(F.col("n") == F.col("last"), "]}").otherwise(",")).alias("value"), "n"
    )
    lines.coalesce(1).sortWithinPartitions("n").select("value").write.text(path)
    return records.flatten_items(records.read_large_items(spark, path)).drop("authors")


def extract_xml_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "xml")
    lei = spark_view(spark, sf_dir, "v_lei")
    record = _nested("lei:LEIRecord", _element("lei:LEI", F.col("id")), _nested("lei:Entity", _element("lei:LegalName", F.col("name"))))
    lei.select(record.alias("value")).write.text(path)
    return records.read_legal_entities(spark, path)


# --- operators on several entities -----------------------------------------------------


def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "works", "persons")
    found = {
        "date": metrics.missing_values(e["works"], F.substring("date", 1, 4), metrics.population_years(AS_OF_YEAR)),
        "type": metrics.missing_values(e["works"], F.col("type"), rules.WORK_TYPES),
        "country": metrics.missing_values(e["persons"], F.col("country"), rules.COUNTRIES),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("domain"), "value") for name, df in found.items()])


def correct_array_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.array_elements(load(spark, sf_dir, "works")["works"], "authors", rules.OWNER_ID).select(
        F.lit("works.authors").alias("indicator"), "hits", "base"
    )


def org_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = registry.count_name_mismatches(load(spark, sf_dir, "orgUnits", "ROR", "lei", "fundref"))
    return counts.select("type", "orgs", "mismatches", (1 - F.col("mismatches") / F.col("orgs")).alias("value"))


def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = metrics.indicators(load(spark, sf_dir), list(rules.WEIGHTS), AS_OF_YEAR)
    return report.metric_scores(frame).select("metric", "score")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.analyze(load(spark, sf_dir), ["complete"], AS_OF_YEAR)


def dimension_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(spark, sf_dir).where(F.col("indicator").isin(report.ALL_DIMENSIONS))


def entry_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_entries(load(spark, sf_dir, "persons", "works", "orgUnits"))


def correct_min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = []
    for entity, df in load(spark, sf_dir, "works", "persons").items():
        short = correct.null_short_values(df, entity)
        key = "orcid_publication_id" if entity == "works" else "id"
        values = [F.col(c).alias(a) for c, a in zip(rules.MIN_LENGTHS[entity], "abcd")]
        frames.append(short.select(F.lit(entity).alias("entity"), F.col(key).alias("id"), *values))
    return reduce(DataFrame.unionByName, frames)


def correct_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.correct_org_names(load(spark, sf_dir, "orgUnits", "ROR", "lei", "fundref"))


def join_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "works", "crossRef")
    return flat_works(enrich.enrich_works(e["works"], e["crossRef"]))


def union_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "works", "persons", "crossRef")
    cited = parse.add_cited_persons(e["persons"], e["works"])
    return flat_affiliations(enrich.add_reference_persons(cited, enrich.join_reference(e["works"], e["crossRef"])))


def duplicate_key_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "works", "persons")
    return merge.add_duplicate_key_with_names(e["works"], e["persons"]).select("orcid_publication_id", "key")


def merge_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "works", "persons")
    return flat_affiliations(merge.merge_persons(e["persons"], merge.merge_works(e["works"])))


def filter_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "works", "persons")
    works = filters.keep_minimal_works(e["works"]).select(F.lit("works").alias("entity"), F.col("orcid_publication_id").alias("id"))
    return works.unionByName(filters.keep_minimal_persons(e["persons"]).select(F.lit("persons").alias("entity"), "id"))


def full_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_works(chain.transform(load(spark, sf_dir))["works"])


def full_chain_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.transform(load(spark, sf_dir))["orgUnits"]


def selected_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.analyze(load(spark, sf_dir), ["NotNull", "UniqueObject"], AS_OF_YEAR)


def full_chain_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_affiliations(chain.transform(load(spark, sf_dir))["persons"])


def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the initial state after that of a state with other works: the rest comes from the store."""
    root = scratch_path(spark, "states")
    states.write_state(root, states.INITIAL, load(spark, sf_dir, "works", "persons", "orgUnits", "ROR", "lei", "fundref"))
    corrected = chain.run_transformation(spark, root, "CorrectContradict")
    partials.analyze(spark, root, corrected, f"{root}/partials", AS_OF_YEAR)
    return partials.analyze(spark, root, states.INITIAL, f"{root}/partials", AS_OF_YEAR)


def unique_value_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two halves of the works, merged: bases, and whether the estimates are within 3 % of the exact counts."""
    works, columns = load(spark, sf_dir, "works")["works"], ["bibtex", "orcid_publication_id", "doi"]
    even = F.coalesce(F.crc32("orcid_publication_id") % 2 == 0, F.lit(True))
    halves = [metrics.distinct_sketches(works.where(half), columns) for half in (even, ~even)]
    estimated = metrics.estimate_distinct(metrics.merge_sketches(halves[0].unionByName(halves[1])))
    exact = metrics.count_distinct(works, columns).select("column", F.col("hits").alias("exact"))
    near = F.abs(F.col("hits") - F.col("exact")) <= 0.03 * F.col("exact")
    return estimated.join(exact, "column").select("column", "base", near.alias("near"))


def _measured(spark: SparkSession, sf_dir: str) -> str:
    """Table of four measurements: the initial state and the filtered one, twice."""
    path = scratch_path(spark, "measurements")
    entities = load(spark, sf_dir, "works", "persons", "orgUnits")
    filtered = entities | {"works": filters.keep_minimal_works(entities["works"]), "persons": filters.keep_minimal_persons(entities["persons"])}
    for chain_name, frames in (("initial", entities), ("FilterObjects", filtered)) * 2:
        report.append_measurement(frames, path, chain_name, ["MinObject"], AS_OF_YEAR)
    return path


def append_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.read_measurements(spark, _measured(spark, sf_dir)).drop("time")


def append_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured, path = report.read_measurements(spark, _measured(spark, sf_dir)), scratch_path(spark, "monitoring")
    monitor.append_monitoring(measured, path, "MinObject", "initial", "FilterObjects")
    changes = monitor.read_monitoring(spark, path)
    return changes.select(
        "run_seq", "base_chain", "result_chain", "kind", "indicator", "base_run_seq_last", "base_run_seq_before",
        "result_run_seq_last", "result_run_seq_before", "base_change", "improvement_last", "improvement_change",
    )


def monitor_query(*columns: str) -> Query:
    return lambda spark, sf_dir: monitor.monitor(spark_view(spark, sf_dir, "v_measurements")).select("kind", "indicator", *columns)


def all_queries() -> dict[str, Query]:
    c = F.col
    items = lambda df: df.select(F.inline("items"))
    queries: dict[str, Query] = {
        "q_ingest_json": ingest_json,
        "q_ingest_csv": ingest_csv,
        "q_ingest_damaged": ingest_damaged,
        "q_ingest_one_entity": ingest_one_entity,
        "q_schema_roundtrip": schema_roundtrip,
        "q_state_roundtrip": state_roundtrip,
        "q_stack_parse": stack_query("Parse", "works"),
        "q_stack_correct": stack_query("Correct", "works"),
        "q_stack_filter": stack_query("Filter", "persons"),
        "q_state_fallback": state_fallback,
        "q_extract_xml_persons": extract_xml_persons,
        "q_extract_xml_works": extract_xml_works,
        "q_extract_xml_damaged": extract_xml_damaged,
        "q_extract_xml_registry": extract_xml_registry,
        "q_extract_date_parts": view_query(
            "v_raw_works", lambda df: df.select("pub_id", extract.publication_date(c("publication_date")).alias("date"))
        ),
        "q_extract_citation": view_query(
            "v_raw_works", lambda df: df.select("pub_id", extract.citation_text(c("citation")).alias("bibtex"))
        ),
        "q_extract_authors": view_query(
            "v_raw_works", lambda df: df.select("pub_id", F.inline(extract.author_contributors(c("contributors"))))
        ),
        "q_extract_external_ids": view_query(
            "v_raw_works",
            lambda df: df.select("pub_id", *[extract.external_id(c("external_ids"), t).alias(t) for t in ("doi", "issn", "isbn")]),
        ),
        "q_author_ids": view_query(
            "v_raw_works",
            lambda df: df.select("pub_id", F.inline(extract.authors_with_ids(c("contributors"), c("pub_id")))).withColumnRenamed("id", "author_id"),
        ),
        "q_ids_from_path": view_query(
            "v_raw_works",
            lambda df: df.select(
                "path", records.publication_id(c("path")).alias("orcid_publication_id"), records.owner_id(c("path")).alias("orcid_id")
            ),
        ),
        "q_isolate_orgs": view_query("v_raw_persons", extract.isolate_organisations),
        "q_read_items": read_items,
        "q_flatten_items": view_query("v_raw_items", lambda df: records.flatten_items(items(df)).drop("authors")),
        "q_flatten_authors": view_query(
            "v_raw_items", lambda df: records.flatten_items(items(df)).select("doi", F.inline("authors"))
        ),
        "q_not_null": indicator_query("NotNull"),
        "q_min_length": indicator_query("MinLength"),
        "q_min_value": indicator_query("MinValue"),
        "q_min_population": indicator_query("MinPopulation"),
        "q_min_object": indicator_query("MinObject"),
        "q_correct_value": indicator_query("CorrectValue"),
        "q_correct_nested": lambda spark, sf_dir: indicator_query("CorrectValue")(spark, sf_dir)
        .where(c("indicator").startswith("persons.affiliations."))
        .drop("metric"),
        "q_correct_array_elements": correct_array_elements,
        "q_correct_orgs_metric": org_metric,
        "q_unique_value": indicator_query("UniqueValue"),
        "q_no_contradict": indicator_query("NoContradict"),
        "q_unique_object": indicator_query("UniqueObject"),
        "q_missing_values": missing_values,
        "q_weighted_score": weighted_score,
        "q_dimension_scores": dimension_scores,
        "q_quality_report": quality_report,
        "q_entry_count": entry_count,
        "q_parse_citation": entity_query(parse.fill_works_from_citations, "works"),
        "q_parse_citation_authors": entity_query(
            lambda works: parse.cited_authors(works).select("orcid_publication_id", F.inline("_authors")),
            "works", "orcid_publication_id", "id", "otherNames",
        ),
        "q_parse_values": entity_query(parse.fill_works_from_labels, "works", "orcid_publication_id", "issn", "isbn", "doi"),
        "q_correct_orgs": correct_orgs,
        "q_correct_min_length": correct_min_length,
        "q_correct_values_ids": entity_query(correct.correct_work_values, "works", "orcid_publication_id", "issn", "isbn", "url", "doi"),
        "q_correct_values_works": entity_query(
            correct.correct_work_values, "works", "orcid_publication_id", "abstract", "title", "subTitle"
        ),
        "q_correct_values_persons": entity_query(
            correct.correct_person_values, "persons", "country", "firstName", "id", "lastName", "otherNames", "publishedName"
        ),
        "q_correct_affiliations": entity_query(correct.correct_person_values, "persons", "id", "affiliations"),
        "q_correct_contradict": entity_query(correct.prefer_issn, "works", "orcid_publication_id", "issn", "isbn"),
        "q_join_enrich": join_enrich,
        "q_union_authors": union_authors,
        "q_normalise_text": entity_query(
            lambda works: text.normalise(works.withColumn("normalised", c("title")), "normalised"),
            "works", "orcid_publication_id", "normalised",
        ),
        "q_duplicate_key": entity_query(merge.add_duplicate_key, "works", "orcid_publication_id", "key"),
        "q_duplicate_key_names": duplicate_key_names,
        "q_merge_works": entity_query(merge.merge_works, "works"),
        "q_merge_persons": merge_persons,
        "q_filter_contradict": entity_query(filters.drop_contradicting_years, "persons", "id", "affiliations"),
        "q_filter_objects": filter_objects,
        "q_full_chain": full_chain,
        "q_full_chain_persons": full_chain_persons,
        "q_full_chain_orgs": full_chain_orgs,
        "q_selected_metrics": selected_metrics,
        "q_sample_extremes": entity_query(partial(sample.sample_extremes, attribute="title", descending=True), "works", "title"),
        "q_sample_nested": entity_query(
            partial(sample.sample_extremes, attribute="affiliations.startYear", n=500), "persons", "startYear"
        ),
        "q_incremental_report": incremental_report,
        "q_unique_value_approximate": unique_value_approximate,
        "q_append_measurements": append_measurements,
        "q_append_monitoring": append_monitoring,
        "q_monitor_base": monitor_query("base_change"),
        "q_monitor_improvement": monitor_query("improvement_before", "improvement_last", "improvement_change"),
        "q_monitor_guard": view_query("v_measurements", monitor.run_counts),
    }
    return {name: with_local_scratch(query) for name, query in queries.items()}
