"""Feed specifications: column order, declared type and width, key flags.

A ``FeedSpec`` is the single source for the raw read schema (all strings,
positional), the typed schema, the key list and the declared widths.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

START_DATE = "start_date"
END_DATE = "end_date"
TECH_COLUMNS = (START_DATE, END_DATE)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str            # "string" | "int" | "date"
    width: int | None    # declared width of string columns; None = unbounded
    is_key: bool = False
    drop_time: bool = False   # date given with a time part to cut off first

    @property
    def spark_type(self) -> T.DataType:
        return {"string": T.StringType(), "int": T.IntegerType(),
                "date": T.DateType()}[self.kind]


@dataclass(frozen=True)
class FeedSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    file_token: str = ""                  # routing substring of file names
    required: tuple[str, ...] = ()        # extra raw not-null columns on FULL loads
    renames: tuple[tuple[str, str], ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.is_key]

    @property
    def values(self) -> list[str]:
        return [c.name for c in self.columns if not c.is_key]

    @property
    def first_key(self) -> str:
        return self.keys[0]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def raw_schema(self, with_tech: bool = True) -> T.StructType:
        """Every column a nullable string, plus the two technical columns
        (which also absorb up to two surplus fields of a long line)."""
        names = self.names + (list(TECH_COLUMNS) if with_tech else [])
        return T.StructType([T.StructField(n, T.StringType(), True) for n in names])

    def typed_schema(self, with_tech: bool = True) -> T.StructType:
        fields = [T.StructField(c.name, c.spark_type, True) for c in self.columns]
        if with_tech:
            fields += [T.StructField(n, T.DateType(), True) for n in TECH_COLUMNS]
        return T.StructType(fields)

    def ddl(self, with_tech: bool = True) -> str:
        """Table DDL with declared widths (VARCHAR(n) enforces them on write)."""
        parts = []
        for c in self.columns:
            if c.kind == "string":
                t = f"VARCHAR({c.width})" if c.width else "STRING"
            else:
                t = {"int": "INT", "date": "DATE"}[c.kind]
            parts.append(f"`{c.name}` {t}")
        if with_tech:
            parts += [f"`{n}` DATE" for n in TECH_COLUMNS]
        return ", ".join(parts)


_DECL = re.compile(r"^(nvarchar|varchar)\((\d+|max)\)$|^(int|date)$")


def parse_layout(text: str) -> tuple[ColumnSpec, ...]:
    """Parse ``name declared_type [key] [drop_time]`` lines."""
    cols = []
    for line in text.strip().splitlines():
        parts = line.split()
        name, decl, flags = parts[0], parts[1], set(parts[2:])
        m = _DECL.match(decl)
        if not m:
            raise ValueError(f"bad declared type {decl!r} for {name}")
        if m.group(3):
            kind, width = m.group(3), None
        else:
            kind = "string"
            width = None if m.group(2) == "max" else int(m.group(2))
        cols.append(ColumnSpec(name, kind, width, "key" in flags, "drop_time" in flags))
    return tuple(cols)


def make_spec(name: str, layout: str, **kw) -> FeedSpec:
    return FeedSpec(name, parse_layout(layout), **kw)


# --- Fixed values -----------------------------------------------------------
# The four published feed layouts: column names in file order, declared types
# (widths as declared for the load step) and key flags.  `drop_time` marks the
# one date column whose values carry a time part that is cut off before
# parsing.  These must equal the source layouts for positional reads to work.

FOIDEV_DEVICE_LAYOUT = """
mdr_report_key nvarchar(50) key
device_event_key nvarchar(50)
implant_flag nvarchar(50)
date_removed_flag nvarchar(50)
device_sequence_no nvarchar(50) key
date_received date
brand_name nvarchar(600)
generic_name nvarchar(600)
manufacturer_d_name nvarchar(200)
manufacturer_d_address_1 nvarchar(200)
manufacturer_d_address_2 nvarchar(200)
manufacturer_d_city nvarchar(200)
manufacturer_d_state_code nvarchar(100)
manufacturer_d_zip_code nvarchar(50)
manufacturer_d_zip_code_ext nvarchar(50)
manufacturer_d_country_code nvarchar(50)
manufacturer_d_postal_code nvarchar(70)
expiration_date_of_device nvarchar(100)
model_number nvarchar(300)
catalog_number nvarchar(200)
lot_number nvarchar(100)
other_id_number nvarchar(200)
device_operator nvarchar(50)
device_availability nvarchar(50)
date_returned_to_manufacturer date
device_report_product_code nvarchar(50)
device_age_text nvarchar(50)
device_evaluated_by_manufactur nvarchar(100)
combination_product_flag nvarchar(100)
udi-di nvarchar(200)
udi-public nvarchar(200)
"""

FOITEXT_TEXT_LAYOUT = """
mdr_report_key nvarchar(50) key
mdr_text_key nvarchar(50) key
text_type_code nvarchar(50)
patient_sequence_number int
date_report date
text nvarchar(max)
"""

MDRFOI_EVENT_LAYOUT = """
mdr_report_key nvarchar(50) key
event_key nvarchar(50) key
report_number nvarchar(50)
report_source_code nvarchar(50)
manufacturer_link_flag_ nvarchar(50)
number_devices_in_event int
number_patients_in_event nvarchar(50)
date_received date
adverse_event_flag nvarchar(50)
product_problem_flag nvarchar(50)
date_report date
date_of_event date
reprocessed_and_reused_flag nvarchar(50)
reporter_occupation_code nvarchar(50)
health_professional nvarchar(50)
initial_report_to_fda nvarchar(50)
date_facility_aware date drop_time
report_date date
report_to_fda nvarchar(50)
date_report_to_fda date
event_location nvarchar(50)
date_report_to_manufacturer date
manufacturer_contact_t_name nvarchar(50)
manufacturer_contact_f_name nvarchar(50)
manufacturer_contact_l_name nvarchar(50)
manufacturer_contact_street_1 nvarchar(100)
manufacturer_contact_street_2 nvarchar(100)
manufacturer_contact_city nvarchar(50)
manufacturer_contact_state nvarchar(50)
manufacturer_contact_zip_code nvarchar(50)
manufacturer_contact_zip_ext nvarchar(50)
manufacturer_contact_country nvarchar(50)
manufacturer_contact_postal nvarchar(50)
manufacturer_contact_area_code nvarchar(50)
manufacturer_contact_exchange nvarchar(50)
manufacturer_contact_phone_no nvarchar(50)
manufacturer_contact_extension nvarchar(50)
manufacturer_contact_pcountry nvarchar(50)
manufacturer_contact_pcity nvarchar(50)
manufacturer_contact_plocal nvarchar(50)
manufacturer_g1_name nvarchar(100)
manufacturer_g1_street_1 nvarchar(100)
manufacturer_g1_street_2 nvarchar(100)
manufacturer_g1_city nvarchar(60)
manufacturer_g1_state_code nvarchar(50)
manufacturer_g1_zip_code nvarchar(50)
manufacturer_g1_zip_code_ext nvarchar(50)
manufacturer_g1_country_code nvarchar(50)
manufacturer_g1_postal_code nvarchar(50)
date_manufacturer_received date
device_date_of_manufacture date
single_use_flag nvarchar(50)
remedial_action nvarchar(50)
previous_use_code nvarchar(50)
removal_correction_number nvarchar(50)
event_type nvarchar(50)
distributor_name nvarchar(50)
distributor_address_1 nvarchar(50)
distributor_address_2 nvarchar(50)
distributor_city nvarchar(50)
distributor_state_code nvarchar(50)
distributor_zip_code nvarchar(50)
distributor_zip_code_ext nvarchar(50)
report_to_manufacturer nvarchar(50)
manufacturer_name nvarchar(50)
manufacturer_address_1 nvarchar(50)
manufacturer_address_2 nvarchar(50)
manufacturer_city nvarchar(50)
manufacturer_state_code nvarchar(50)
manufacturer_zip_code nvarchar(50)
manufacturer_zip_code_ext nvarchar(50)
manufacturer_country_code nvarchar(50)
manufacturer_postal_code nvarchar(50)
type_of_report nvarchar(50)
source_type nvarchar(50)
date_added date
date_changed date
reporter_country_code nvarchar(50)
pma_pmn_num nvarchar(50)
exemption_number nvarchar(50)
summary_report nvarchar(350)
noe_summarized nvarchar(150)
"""

PATIENT_LAYOUT = """
mdr_report_key nvarchar(50) key
patient_sequence_number int key
date_received date
sequence_number_treatment nvarchar(4000)
sequence_number_outcome nvarchar(100)
"""

# Feed name -> file-name token used for routing; the event feed's FULL load
# also requires a raw `date_added`; the text feed renames `foi_text`.
FEEDS: dict[str, FeedSpec] = {
    "mdrfoi_event": make_spec("mdrfoi_event", MDRFOI_EVENT_LAYOUT,
                              file_token="mdrfoi", required=("date_added",)),
    "patient": make_spec("patient", PATIENT_LAYOUT, file_token="patient"),
    "foidev_device": make_spec("foidev_device", FOIDEV_DEVICE_LAYOUT, file_token="dev"),
    "foitext_text": make_spec("foitext_text", FOITEXT_TEXT_LAYOUT, file_token="foitext",
                              renames=(("foi_text", "text"),)),
}

# Feed processing order of a multi-feed run.
FEED_ORDER = ("mdrfoi_event", "patient", "foidev_device", "foitext_text")
