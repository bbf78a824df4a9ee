"""Schemas of the entities; every leaf is a nullable string. All names are fixed values."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


AFFILIATION = T.StructType(_strings("endYear", "orgID", "role", "startYear"))
REFERENCE_AUTHOR = T.StructType(_strings("firstName", "id", "lastName"))

WORKS = T.StructType(
    _strings("abstract")
    + [T.StructField("authors", T.ArrayType(T.StringType()))]
    + _strings(
        "bibtex", "date", "doi", "isbn", "issn", "journal_title", "orcid_id",
        "orcid_publication_id", "subTitle", "title", "type", "url",
    )
)
PERSONS = T.StructType(
    [T.StructField("affiliations", T.ArrayType(AFFILIATION))]
    + _strings("country", "firstName", "id", "lastName", "otherNames", "publishedName")
)
ORG_UNITS = T.StructType(_strings("id", "name", "type"))
CROSS_REF = T.StructType(
    _strings("abstract")
    + [T.StructField("authors", T.ArrayType(REFERENCE_AUTHOR))]
    + _strings("date", "doi", "isbn", "issn", "subTitle", "title", "type", "url")
)
LEI = T.StructType(_strings("id", "name"))
FUNDREF = T.StructType(_strings("uri", "primary_name_display", "replaced"))
ROR = T.StructType(
    _strings(
        "id", "name", "types", "status", "links", "aliases", "labels", "acronyms",
        "wikipedia_url", "established",
        "addresses[0].lat", "addresses[0].lng",
        "addresses[0].geonames_city.name", "addresses[0].geonames_city.id",
        "addresses[0].geonames_city.geonames_admin1.name",
        "addresses[0].geonames_city.geonames_admin1.code",
        "addresses[0].geonames_city.geonames_admin2.name",
        "addresses[0].geonames_city.geonames_admin2.code",
        "country.country_code", "country.country_name",
        "external_ids.GRID.preferred", "external_ids.GRID.all",
        "external_ids.ISNI.preferred", "external_ids.ISNI.all",
        "external_ids.FundRef.preferred", "external_ids.FundRef.all",
        "external_ids.Wikidata.preferred", "external_ids.Wikidata.all",
        "relationships",
    )
)

ENTITIES = {
    "persons": PERSONS,
    "works": WORKS,
    "orgUnits": ORG_UNITS,
    "crossRef": CROSS_REF,
    "lei": LEI,
    "ROR": ROR,
    "fundref": FUNDREF,
}
