"""Declared schemas of the clinical CSV tables; files are read by position, so the order of columns is contract."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: columns and types, in file order
DDL = {
    "patients": """Id string NOT NULL, BIRTHDATE date NOT NULL, DEATHDATE date, SSN string, DRIVERS string, PASSPORT string, PREFIX string, FIRST string,
        MIDDLE string, LAST string, SUFFIX string, MAIDEN string, MARITAL string, RACE string, ETHNICITY string, GENDER string, BIRTHPLACE string,
        ADDRESS string, CITY string, STATE string, COUNTY string, FIPS string, ZIP string, LAT double, LON double, HEALTHCARE_EXPENSES double,
        HEALTHCARE_COVERAGE double, INCOME double""",
    "encounters": """Id string NOT NULL, START timestamp NOT NULL, STOP timestamp, PATIENT string NOT NULL, ORGANIZATION string, PROVIDER string,
        PAYER string, ENCOUNTERCLASS string, CODE string, DESCRIPTION string, BASE_ENCOUNTER_COST double, TOTAL_CLAIM_COST double,
        PAYER_COVERAGE double, REASONCODE string, REASONDESCRIPTION string""",
    "conditions": "START date NOT NULL, STOP date, PATIENT string NOT NULL, ENCOUNTER string, SYSTEM string, CODE string, DESCRIPTION string",
    "medications": """START timestamp NOT NULL, STOP timestamp, PATIENT string NOT NULL, PAYER string, ENCOUNTER string, CODE string, DESCRIPTION string,
        BASE_COST double, PAYER_COVERAGE double, DISPENSES int, TOTALCOST double, REASONCODE string, REASONDESCRIPTION string""",
    "procedures": """START timestamp NOT NULL, STOP timestamp, PATIENT string NOT NULL, ENCOUNTER string, SYSTEM string, CODE string,
        DESCRIPTION string, BASE_COST double, REASONCODE string, REASONDESCRIPTION string""",
    "careplans": """Id string NOT NULL, START date NOT NULL, STOP date, PATIENT string NOT NULL, ENCOUNTER string, CODE string, DESCRIPTION string,
        REASONCODE string, REASONDESCRIPTION string""",
    "observations": """DATE timestamp NOT NULL, PATIENT string NOT NULL, ENCOUNTER string, CATEGORY string, CODE string, DESCRIPTION string,
        VALUE string, UNITS string, TYPE string""",
    "payers": """Id string NOT NULL, NAME string, OWNERSHIP string, ADDRESS string, CITY string, STATE_HEADQUARTERED string, ZIP string, PHONE string,
        AMOUNT_COVERED double, AMOUNT_UNCOVERED double, REVENUE double, COVERED_ENCOUNTERS int, UNCOVERED_ENCOUNTERS int, COVERED_MEDICATIONS int,
        UNCOVERED_MEDICATIONS int, COVERED_PROCEDURES int, UNCOVERED_PROCEDURES int, COVERED_IMMUNIZATIONS int, UNCOVERED_IMMUNIZATIONS int,
        UNIQUE_CUSTOMERS int, QOLS_AVG double, MEMBER_MONTHS int""",
    "providers": """Id string NOT NULL, ORGANIZATION string, NAME string, GENDER string, SPECIALITY string, ADDRESS string, CITY string, STATE string,
        ZIP string, LAT double, LON double, ENCOUNTERS int, PROCEDURES int""",
    "organizations": """Id string NOT NULL, NAME string, ADDRESS string, CITY string, STATE string, ZIP string, LAT double, LON double, PHONE string,
        REVENUE double, UTILIZATION int""",
}
_KINDS = {"string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "double": T.DoubleType(), "int": T.IntegerType()}


def declared(ddl: str) -> T.StructType:
    """A schema from ``name kind [NOT NULL], ...``, without a session."""
    parts = [column.split() for column in ddl.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind], not rest) for name, kind, *rest in parts])


SCHEMAS = {name: declared(ddl) for name, ddl in DDL.items()}
