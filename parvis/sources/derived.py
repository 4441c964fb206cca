"""Listings and sales derived from the `part` and `lineitem` tables.

The text of each view is valid in Spark and in DuckDB; ``FIXTURES.md`` describes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SALES_SQL = """
select concat('M', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as id_mutation,
  make_date(case when l_suppkey % 10 = 8 then 2022 else 2022 + year(l_shipdate) % 3 end, month(l_shipdate),
    least(day(l_shipdate), 28)) as date_mutation,
  cast(75001 + l_suppkey % 20 as int) as code_postal,
  case when l_partkey % 10 = 0 then 'Maison' else 'Appartement' end as type_local,
  surface as surface_reelle_bati,
  (8000 + 200 * (l_suppkey % 20) + l_discount * 10000) * surface as valeur_fonciere,
  case when l_linenumber = 3 then null else cast(floor(surface / 28) as int) end as nombre_pieces_principales
from (
  select *, (case when l_suppkey % 10 = 9 or l_suppkey % 20 = 18 then l_quantity % 4 + 1 else l_quantity end)
    * 2e0 + 10 + (l_orderkey % 1000) / 1000e0 as surface
  from {lineitem}) sized
"""

LISTINGS_SQL = """
with base as (
  select p_partkey as row_idx,
    concat('UPF', lpad(cast(p_partkey as string), 6, '0')) as listing_id,
    case when p_partkey % 11 = 0 then ''
         else concat(cast(1 + p_partkey % 97 as string), ' bd ', p_name, ' ', lower(p_brand)) end as raw_address,
    case when p_partkey % 11 <> 0 then 'Appartement lumineux'
         when p_partkey % 3 = 0 then 'Studio, 12 rue des Martyrs, 75009 Paris'
         when p_partkey % 3 = 1 then 'Studio du 5eme arrondissement'
         else 'Charmant studio' end as description,
    cast(case when p_partkey % 97 = 5 then 75116 else 75001 + p_partkey % 20 end as int) as code_postal,
    cast(p_size * 2 + 10 as double) as surface_m2,
    cast(floor((8500 + 200 * (p_partkey % 20)) * (p_size * 2 + 10)
      * (case p_partkey % 8 when 0 then 0.8e0 when 1 then 1.25e0 else 1.0e0 end)) as bigint) as asking_price,
    case p_partkey % 3 when 0 then 'SeLoger' when 1 then 'LeBonCoin' else 'PAP' end as source,
    case p_partkey % 8 when 0 then 'under' when 1 then 'over' else 'fair' end as pricing_bias,
    case p_partkey % 5 when 0 then ' maison' when 1 then 'Appartement' when 2 then 'Loft' end as property_type
  from {part})
select * from base
union all
select row_idx + 10000000, concat('DUX', substr(listing_id, 4)), replace(raw_address, ' bd ', ', Boulevard '),
  description, code_postal, surface_m2, cast(floor(asking_price * 1.02e0) as bigint), 'PAP', pricing_bias, property_type
from base where row_idx % 14 = 2
union all
select row_idx + 20000000, concat('DUF', substr(listing_id, 4)), replace(raw_address, ' bd ', ' bvd '),
  description, code_postal, surface_m2 + 2, cast(floor(asking_price * 0.99e0) as bigint), 'SeLoger', pricing_bias, property_type
from base where row_idx % 15 = 4
"""


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(LISTINGS_SQL, part=spark.read.parquet(f"{folder}/part.parquet"))


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(SALES_SQL, lineitem=spark.read.parquet(f"{folder}/lineitem.parquet"))
