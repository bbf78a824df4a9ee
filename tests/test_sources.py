import gzip
import json
import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pubgrade import schemas
from pubgrade.operators import extract
from pubgrade.plans import chain
from pubgrade.sources import ingest, records, scratch, states


def test_fallback_chains():
    assert states.fallback_chains("a.b.c") == ["a.b.c", "a.b", "a", "initial"]
    assert states.fallback_chains("initial") == ["initial"]
    assert states.extend_chain("initial", "Merge") == "Merge"
    assert states.extend_chain("a.b", "Merge") == "a.b.Merge"


def test_ingest(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    with gzip.open(source / "persons.jsonl.gz", "wt") as out:
        out.write(json.dumps({"id": "1", "otherNames": ["a", "b"], "affiliations": [{"startYear": "2001"}]}) + "\n")
        out.write(json.dumps({"id": "2", "otherNames": "c"}) + "\n")
    (source / "authors_1.jsonl").write_text(json.dumps({"id": "3", "firstName": "X"}) + "\n")
    (source / "lei.csv").write_text('id,name,extra\n1,"A, B",x\n2,,y\n')
    sources = {"persons": [str(source / "persons.jsonl.gz"), str(source / "authors_*")], "lei": str(source / "lei.csv")}
    assert ingest.ingest(spark, sources, root, entity="lei") == ["lei"]
    assert states.read_entities(spark, root).keys() == {"lei"}
    ingest.ingest(spark, sources, root)
    found = states.read_entities(spark, root)
    persons = {r.id: r for r in found["persons"].collect()}
    assert json.loads(persons["1"].otherNames) == ["a", "b"] and persons["2"].otherNames == "c" and persons["3"].firstName == "X"
    assert persons["1"].affiliations[0].startYear == "2001"
    assert sorted(tuple(r) for r in found["lei"].collect()) == [("1", "A, B"), ("2", None)]
    assert ingest.load_schema(spark, f"{root}/schemes/persons") == schemas.PERSONS


def test_dotted_csv_columns(spark, tmp_path):
    header = ",".join(schemas.ROR.names)
    (tmp_path / "ROR.csv").write_text(header + "\n" + ",".join(str(i) for i in range(29)) + "\n")
    row = ingest.read_source(spark, str(tmp_path / "ROR.csv"), schemas.ROR).collect()[0]
    assert row["external_ids.GRID.preferred"] == "20" and row["addresses[0].lat"] == "10"


def test_states(spark, frame, tmp_path):
    root = str(tmp_path)
    works = frame("works", {"title": "t", "isbn": "1", "issn": "2", "doi": "d"}, {"title": None, "isbn": "1"})
    states.write_state(root, "initial", {"works": works, "persons": frame("persons", {"id": "1", "otherNames": "x"})})
    assert chain.run_transformation(spark, root, "FilterObjects") == "FilterObjects"
    assert chain.run_transformation(spark, root, "CorrectContradict", "FilterObjects") == "FilterObjects.CorrectContradict"
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".cuts")]
    with pytest.raises(ValueError):
        states.read_entities(spark, root, "Mistyped")
    found = states.read_entities(spark, root, "FilterObjects.CorrectContradict.Unknown")
    assert [r.isbn for r in found["works"].collect()] == [None]
    assert found["persons"].count() == 1 and "orgUnits" not in found
    assert states.read_entity(spark, root, "initial", "works").count() == 2


def test_entities_are_written_at_the_same_time(frame, tmp_path, monkeypatch):
    both, entities = threading.Barrier(2), {name: frame(name, {}) for name in ("works", "persons")}
    writer = type(entities["works"].write)
    plain = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path: (both.wait(20), plain(self, path)))
    states.write_state(str(tmp_path), states.INITIAL, entities)
    assert {name: entities[name].count() for name in entities} == {"works": 1, "persons": 1}


def test_half_written_state_is_refused(spark, frame, tmp_path):
    works = frame("works", {"title": "t"})
    broken = frame("persons", {"id": "1"}).select("*", F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception):
        states.write_state(str(tmp_path), "initial", {"works": works, "persons": broken})
    with pytest.raises(ValueError):
        states.read_entities(spark, str(tmp_path))
    states.write_state(str(tmp_path), "initial", {"works": works})
    assert states.read_entities(spark, str(tmp_path)).keys() == {"works"}


def test_damaged_sources(spark, tmp_path):
    (tmp_path / "lei.csv").write_text('id,name\n1,"A"\n2\n3,b,c\n4,d\n')
    path = str(tmp_path / "lei.csv")
    assert sorted(r.id for r in ingest.read_csv(spark, path, schemas.LEI).collect()) == ["1", "4"]
    assert ingest.read_csv(spark, path, schemas.LEI, damaged="only").count() == 2
    (tmp_path / "a.json").write_text('{"items": [{"DOI": "1"}]}')
    (tmp_path / "b.json").write_text('{"items": [{"DOI": "2"')
    files = str(tmp_path / "*.json")
    assert [r.DOI for r in records.read_items(spark, files).collect()] == ["1"]
    assert records.read_items(spark, files, damaged="only").count() == 1
    with pytest.raises(Exception):
        records.read_items(spark, files, damaged="fail").collect()


def session(master, folder):
    conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{folder}"))


def test_scratch_folder(spark):
    assert scratch.scratch_path(session("yarn", "hdfs://shared/"), "x").startswith("hdfs://shared/x-")
    with pytest.raises(ValueError):
        scratch.scratch_root(session("yarn", None))
    assert scratch.scratch_root(spark) == scratch.scratch_root(spark)
    cut = scratch.cut_lineage(spark.range(3).toDF("n"), "numbers")
    assert cut.count() == 3 and f"{scratch.scratch_root(spark)}/numbers-" in cut.inputFiles()[0]


PERSON = """<?xml version="1.0"?>
<record:record path="/x" xmlns:record="http://r" xmlns:person="http://p" xmlns:personal-details="http://d">
 <person:person>
  <person:name visibility="public"><personal-details:given-names>Ann &amp; B</personal-details:given-names></person:name>
  <other-name:other-names><other-name:other-name put-code="1"><other-name:content>O1</other-name:content></other-name:other-name>
   <other-name:other-name><other-name:content>O "2"</other-name:content></other-name:other-name></other-name:other-names>
  <address:addresses><address:address><address:country>DE</address:country></address:address></address:addresses>
 </person:person>
 <activities:activities-summary><activities:employments>
  <activities:affiliation-group><employment:employment-summary put-code="7">
    <common:role-title>Prof</common:role-title>
    <common:start-date><common:year>2001</common:year><common:month>02</common:month></common:start-date>
    <common:organization><common:name>Uni</common:name>
     <common:disambiguated-organization>
      <common:disambiguated-organization-identifier>grid.1</common:disambiguated-organization-identifier>
      <common:disambiguation-source>GRID</common:disambiguation-source></common:disambiguated-organization></common:organization>
  </employment:employment-summary></activities:affiliation-group>
  <activities:affiliation-group><employment:employment-summary><common:organization><common:name>Lab</common:name></common:organization>
  </employment:employment-summary></activities:affiliation-group>
  <activities:affiliation-group><employment:employment-summary></employment:employment-summary></activities:affiliation-group>
 </activities:employments></activities:activities-summary>
</record:record>"""


def test_person_records(spark, tmp_path):
    (tmp_path / "0000-1.xml").write_text(PERSON)
    (tmp_path / "0000-2.xml").write_text("<record:record><person:person></person:person></record:record>")
    persons = records.extract_persons(records.read_members(spark, str(tmp_path))).orderBy("id")
    first, second = persons.collect()
    assert (first.id, first.firstName, first.lastName, first.country) == ("0000-1", "Ann & B", None, "DE")
    assert json.loads(first.otherNames) == ["O1", 'O "2"']
    assert [(a.startYear, a.role, a.orgName, a.orgID, a.orgIDType) for a in first.affiliations] == [
        ("2001", "Prof", "Uni", "grid.1", "GRID"), (None, None, "Lab", None, None),
    ]
    assert second.id == "0000-2" and second.affiliations is None and second.otherNames is None
    orgs = {tuple(r) for r in extract.isolate_organisations(persons).collect()}
    assert orgs == {("grid.1", "Uni", "GRID"), ("Lab", "Lab", None)}
    reduced = extract.person_affiliations(persons)
    assert reduced.schema["affiliations"].dataType.elementType.names == ["startYear", "endYear", "role", "orgID"]


WORK = """<work:work put-code="5">
 <work:title><common:title>T</common:title><common:translated-title>no</common:translated-title></work:title>
 <work:citation><work:citation-type>{type}</work:citation-type><work:citation-value>@misc{{x}}</work:citation-value></work:citation>
 <common:publication-date>{date}</common:publication-date>
 <common:external-ids>
  <common:external-id><common:external-id-type>doi</common:external-id-type><common:external-id-value>a</common:external-id-value>
   <common:external-id-normalized transient="true">A</common:external-id-normalized></common:external-id>
  <common:external-id><common:external-id-type>doi</common:external-id-type><common:external-id-value>b</common:external-id-value></common:external-id>
  <common:external-id><common:external-id-type>other</common:external-id-type><common:external-id-value>c</common:external-id-value></common:external-id>
 </common:external-ids>
 <work:contributors>
  <work:contributor><work:credit-name>Ann</work:credit-name></work:contributor>
  <work:contributor><work:credit-name>Eve</work:credit-name>
   <work:contributor-attributes><work:contributor-role>editor</work:contributor-role></work:contributor-attributes></work:contributor>
  <work:contributor><common:contributor-orcid><common:path>9</common:path></common:contributor-orcid></work:contributor>
  <work:contributor><common:contributor-orcid><common:path>8</common:path></common:contributor-orcid><work:credit-name>Bob</work:credit-name>
   <work:contributor-attributes><work:contributor-role>author</work:contributor-role></work:contributor-attributes></work:contributor>
 </work:contributors></work:work>"""


def test_work_records(spark):
    dates = {
        "y": "<common:year>2001</common:year><common:day>05</common:day>",
        "ym": "<common:year>2001</common:year><common:month>02</common:month>",
        "ymd": "<common:year>2001</common:year><common:month>02</common:month><common:day>05</common:day>",
        "m": "<common:month>02</common:month>",
    }
    rows = [(f"s/0-1_works_{name}.xml", WORK.format(type="bibtex" if name == "y" else "ris", date=d)) for name, d in dates.items()]
    members = spark.createDataFrame(rows, "path string, xml string")
    flat = extract.flatten_works(records.extract_work_records(members))
    found = {r.orcid_publication_id: r for r in flat.collect()}
    assert {n: r.date for n, r in found.items()} == {"y": "2001", "ym": "2001-02", "ymd": "2001-02-05", "m": None}
    assert found["y"].bibtex == "@misc{x}" and found["m"].bibtex is None
    assert (found["y"].doi, found["y"].issn, found["y"].orcid_id, found["y"].title) == ("b", None, "0-1", "T")
    assert found["y"].authors == ["y_0", "8"]
    people = {tuple(r) for r in extract.work_authors(flat.where("orcid_publication_id = 'y'")).collect()}
    assert people == {("y_0", "Ann"), ("8", "Bob")}


def test_legal_entities(spark, tmp_path):
    record = "<lei:LEIRecord><lei:LEI>{0}</lei:LEI><lei:Entity><lei:LegalName xml:lang='en'>N &lt;{0}&gt;</lei:LegalName></lei:Entity></lei:LEIRecord>"
    body = "\n".join(record.format(i) for i in range(500))
    (tmp_path / "lei.xml").write_text(f"<?xml version='1.0'?>\n<lei:LEIData xmlns:lei='http://x'><lei:LEIRecords>\n{body}\n</lei:LEIRecords></lei:LEIData>")
    # small splits, so records cross them
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = records.read_legal_entities(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 5
        assert {tuple(r) for r in found.collect()} == {(str(i), f"N <{i}>") for i in range(500)}
        assert found.count() == 500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_are_parsed_once(spark, tmp_path):
    """Not again by every filter and column that uses the record."""
    members = spark.range(3).selectExpr("concat('summaries/', id, '.xml') as path", "concat('<r>', id, '</r>') as xml")
    jobs = records.extract_persons(members).select("id", F.inline("affiliations"))
    (tmp_path / "items.json").write_text('{"items": [{"DOI": "10.1/1", "author": [{"given": "A", "family": "B"}]}]}')
    authors = records.flatten_items(records.read_large_items(spark, str(tmp_path))).select("doi", F.inline("authors"))
    for df, parser in ((jobs, "from_xml("), (authors, "from_json(")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(parser) == 1


def test_items(spark, tmp_path):
    items = [
        {"DOI": "10.1/a", "type": "book", "title": ["T", "U"], "ISBN": ["1", "2"], "URL": "http://u",
         "author": [{"given": "G", "family": "F", "ORCID": "http://o/7"}, {"family": "H"}],
         "published": {"date-parts": [[2020, 3]]}},
        {"DOI": "10.1/b", "type": "x", "title": [], "author": [], "published": {"date-parts": [[]]}},
        {"DOI": "10.1/c", "type": "x"},
    ]
    with gzip.open(tmp_path / "0.json.gz", "wt") as out:
        json.dump({"items": items}, out, indent=1)
    found = {r.doi: r for r in records.flatten_items(records.read_items(spark, str(tmp_path))).collect()}
    a = found["10.1/a"]
    assert (a.title, a.isbn, a.url, a.date, a.issn) == ("T", "1", "http://u", "2020-3", None)
    assert [tuple(x) for x in a.authors] == [("G", "7", "F"), (None, "10.1/a_1", "H")]
    for doi in ("10.1/b", "10.1/c"):
        assert (found[doi].title, found[doi].authors, found[doi].date) == (None, None, None)
    assert records.flatten_items(records.read_items(spark, str(tmp_path))).schema.simpleString() == schemas.CROSS_REF.simpleString()


@pytest.mark.parametrize("path,publication,owner", [("a/b/0-1_works_12.xml", "12", "0-1"), ("0-1_works_12.x.xml", "12", "0-1")])
def test_ids_from_paths(spark, path, publication, owner):
    row = spark.range(1).select(records.publication_id(F.lit(path)), records.owner_id(F.lit(path))).first()
    assert tuple(row) == (publication, owner)
