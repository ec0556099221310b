"""Geography and product dimensions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary import schemas
from granary.functions.clean import Mapping, align, project, stamp, with_key
from granary.operators.dedup import dedup_by_key
from granary.operators.keys import assign_surrogate_keys, lookup_surrogate_key, same_key


@dataclass(frozen=True)
class Dimension:
    """How one dimension is made: its source, natural key and parent."""

    name: str
    source: str
    mapping: Mapping
    code: str
    sk: str
    parent: str | None = None
    parent_code: str | None = None
    parent_sk: str | None = None
    parent_in_key: bool = False

    @property
    def natural_key(self) -> list[str]:
        return [self.code, self.parent_sk] if self.parent_in_key else [self.code]

    @property
    def source_key(self) -> list[str]:
        return [self.code, self.parent_code] if self.parent_in_key else [self.code]


# Parents come before their children.
DIMENSIONS = [
    Dimension(
        "dim_continent", "LKP_CONTINENT", schemas.CONTINENT_MAP, "continent_code", "continent_sk"
    ),
    Dimension(
        "dim_country",
        "LKP_COUNTRY",
        schemas.COUNTRY_MAP,
        "country_code",
        "country_sk",
        parent="dim_continent",
        parent_code="continent_code",
        parent_sk="continent_sk",
    ),
    Dimension(
        "dim_region",
        "LKP_REGION",
        schemas.REGION_MAP,
        "region_code",
        "region_sk",
        parent="dim_country",
        parent_code="country_code",
        parent_sk="country_sk",
        parent_in_key=True,
    ),
    Dimension(
        "dim_city",
        "LKP_CITY",
        schemas.CITY_MAP,
        "city_id",
        "city_sk",
        parent="dim_region",
        parent_code="region_code",
        parent_sk="region_sk",
    ),
    Dimension(
        "dim_product_line",
        "LKP_PROD_LINE",
        schemas.PRODUCT_LINE_MAP,
        "product_line_code",
        "product_line_sk",
    ),
    Dimension(
        "dim_product_family",
        "LKP_PROD_FAM",
        schemas.PRODUCT_FAMILY_MAP,
        "product_family_code",
        "product_family_sk",
        parent="dim_product_line",
        parent_code="product_line_code",
        parent_sk="product_line_sk",
    ),
]
BY_NAME = {d.name: d for d in DIMENSIONS}


def build_dimension(
    spec: Dimension,
    raw: DataFrame,
    batch_ts: dt.datetime,
    parent: DataFrame | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """The dimension after this extract.

    Rows known to ``existing`` keep their key and creation time. Rows it holds
    that the extract lacks stay, since facts and child rows may point at them.
    """
    rows = dedup_by_key(with_key(project(raw, spec.mapping), [spec.code]), spec.source_key)
    if parent is not None:
        rows = lookup_surrogate_key(
            rows, parent, spec.parent_code, spec.parent_sk, unique=spec.parent != "dim_region"
        )
    now = stamp(batch_ts)
    keyed = assign_surrogate_keys(rows, spec.natural_key, spec.sk, existing, ["created_at"])
    schema = schemas.target_schema(spec.name)
    out = align(
        keyed.withColumns(
            {"created_at": F.coalesce("created_at", now), "updated_at": now}
        ),
        schema,
    )
    if existing is None:
        return out
    gone = existing.join(
        rows, same_key(existing, rows, [(k, k) for k in spec.natural_key]), "left_anti"
    )
    return out.unionByName(align(gone, schema))
