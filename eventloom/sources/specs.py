"""The five datasets: column names in file order, types, header lines and keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names of the archive's file formats, in file order.  A name
# followed by :b is a whole number, by :d a real number; the others are strings.
_EVENT = """
GlobalEventID:b Day:b MonthYear:b Year:b FractionDate:d Actor1Code Actor1Name Actor1CountryCode
Actor1KnownGroupCode Actor1EthnicCode Actor1Religion1Code Actor1Religion2Code Actor1Type1Code Actor1Type2Code
Actor1Type3Code Actor2Code Actor2Name Actor2CountryCode Actor2KnownGroupCode Actor2EthnicCode
Actor2Religion1Code Actor2Religion2Code Actor2Type1Code Actor2Type2Code Actor2Type3Code IsRootEvent:b EventCode
EventBaseCode EventRootCode QuadClass:b GoldsteinScale:d NumMentions:b NumSources:b NumArticles:b AvgTone:d
Actor1Geo_Type:b Actor1Geo_FullName Actor1Geo_CountryCode Actor1Geo_ADM1Code Actor1Geo_Lat:d Actor1Geo_Long:d
Actor1Geo_FeatureID Actor2Geo_Type:b Actor2Geo_FullName Actor2Geo_CountryCode Actor2Geo_ADM1Code Actor2Geo_Lat:d
Actor2Geo_Long:d Actor2Geo_FeatureID ActionGeo_Type:b ActionGeo_FullName ActionGeo_CountryCode
ActionGeo_ADM1Code ActionGeo_Lat:d ActionGeo_Long:d ActionGeo_FeatureID DATEADDED:b SOURCEURL
"""
_GKG_V2 = """
GKGRECORDID V2.1DATE:b V2SOURCECOLLECTIONIDENTIFIER:b V2SOURCECOMMONNAME V2DOCUMENTIDENTIFIER V1COUNTS
V2.1COUNTS V1THEMES V2ENHANCEDTHEMES V1LOCATIONS V2ENHANCEDLOCATIONS V1PERSONS V2ENHANCEDPERSONS
V1ORGANIZATIONS V2ENHANCEDORGANIZATIONS V1.5TONE V2.1ENHANCEDDATES V2GCAM V2.1SHARINGIMAGE V2.1RELATEDIMAGES
V2.1SOCIALIMAGEEMBEDS V2.1SOCIALVIDEOEMBEDS V2.1QUOTATIONS V2.1ALLNAMES V2.1AMOUNTS V2.1TRANSLATIONINFO
V2EXTRASXML
"""
_MENTIONS = """
GLOBALEVENTID:b EventTimeDate:b MentionTimeDate:b MentionType:b MentionSourceName MentionIdentifier
SentenceID:b Actor1CharOffset:b Actor2CharOffset:b ActionCharOffset:b InRawText:b Confidence:b MentionDocLen:b
MentionDocTone:d MentionDocTranslationInfo Extras
"""
_GKG_V1 = "Date:b NumArticles:b Counts Themes Locations Persons Organizations Tone EventIds Sources SourceURLs"
_GKG_V1_COUNTS = """
Date:b NumArticles:b CountType Count:b ObjectType Geo_Type:b Geo_FullName Geo_CountryCode Geo_ADM1Code
Geo_Lat:d Geo_Long:d Geo_FeatureID EventIds Sources SourceURLs
"""

_TYPES = {"b": T.LongType(), "d": T.DoubleType(), "": T.StringType()}


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    layout: str
    header: bool
    period: str  # grammar of file names: see periods.py
    path_prefix: str
    required: tuple[str, ...]  # columns that a join needs
    coverage_start: int | None = None  # first day, yyyymmdd
    schema: T.StructType = field(init=False)

    def __post_init__(self) -> None:
        fields = [part.partition(":") for part in self.layout.split()]
        object.__setattr__(self, "schema", T.StructType([T.StructField(n, _TYPES[k]) for n, _, k in fields]))

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def numeric(self) -> list[str]:
        return [f.name for f in self.schema if not isinstance(f.dataType, T.StringType)]


DATASETS = {
    s.name: s
    for s in (
        DatasetSpec("events", _EVENT, False, "events", "", ("GlobalEventID",)),
        DatasetSpec("gkg_v1", _GKG_V1, True, "daily", "gkg_v1_", ("EventIds",), 20130401),
        DatasetSpec("gkg_v1_counts", _GKG_V1_COUNTS, True, "daily", "gkg_v1_counts_", ("EventIds",), 20130401),
        DatasetSpec("gkg_v2", _GKG_V2, False, "quarter", "gkg_v2_", ("V2DOCUMENTIDENTIFIER",), 20150218),
        DatasetSpec("mentions", _MENTIONS, False, "quarter", "mentions_", ("GLOBALEVENTID", "MentionIdentifier"), 20150218),
    )
}


def spec(dataset: str) -> DatasetSpec:
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset!r}; known: {sorted(DATASETS)}")
    return DATASETS[dataset]
