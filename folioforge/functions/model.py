"""Schemas of the data model as DDL, and codecs between rows and JSON text.

encode() and decode() are inverse for every schema here: nulls are written, times are ISO text, any-JSON values are
kept as JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTIFIER = "struct<neurostore:string,pmid:string,doi:string,pmcid:string,other_ids:map<string,string>>"
FILE = "struct<file_path:string,file_type:string,content_type:string,source:string,downloaded_at:timestamp_ntz,md5:string>"
DOWNLOAD = f"struct<identifier:{IDENTIFIER},source:string,success:boolean,files:array<{FILE}>,error_message:string>"
COORDINATE = "struct<x:double,y:double,z:double,space:string,statistic_value:double,statistic_type:string,cluster_size:int,cluster_measure:string,is_subpeak:boolean,is_deactivation:boolean,is_seed:boolean>"
TABLE = f"struct<table_id:string,raw_content_path:string,table_number:int,caption:string,footer:string,metadata:map<string,string>,coordinates:array<{COORDINATE}>,space:string>"
CONTENT = f"struct<slug:string,source:string,identifier:{IDENTIFIER},full_text:string,tables:array<{TABLE}>,has_coordinates:boolean,error_message:string>"
AUTHOR = "struct<name:string,affiliation:string,orcid:string>"
METADATA = f"struct<title:string,authors:array<{AUTHOR}>,abstract:string,journal:string,publication_year:int,keywords:array<string>,license:string,source:string,open_access:boolean,raw_metadata:map<string,string>>"
ANALYSIS = f"struct<name:string,description:string,coordinates:array<{COORDINATE}>,table_id:string,table_number:int,table_caption:string,table_footer:string,metadata:map<string,string>>"
COLLECTION = f"struct<slug:string,coordinate_space:string,identifier:{IDENTIFIER},analyses:array<{ANALYSIS}>>"
RESULT = f"struct<slug:string,article_slug:string,table_id:string,sanitized_table_id:string,collection:{COLLECTION},error_message:string>"

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false", "timestampNTZFormat": _ISO})


def decode(c: Column, schema: str) -> Column:
    return F.from_json(c, schema, {"timestampNTZFormat": _ISO})


def iso_time(c: Column) -> Column:
    """ISO text of a time without zone; a fraction only where there is one."""
    return F.regexp_replace(F.date_format(c, _ISO), r"\.000000$", "")


def parse_iso(c: Column) -> Column:
    """A time without zone from ISO text; null for anything else."""
    return c.try_cast("timestamp_ntz")


def columns(schema: str) -> str:
    """The fields of a struct schema as the schema of a table."""
    return schema.removeprefix("struct<").removesuffix(">")
