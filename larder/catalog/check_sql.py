"""DuckDB text of the shared pieces: lookups, draws and the product rows over ``part``."""

from __future__ import annotations

from larder import values
from larder.functions import draws as D
from larder.lookups import values_sql

_TYPES = {
    "string": "varchar",
    "int": "integer",
    "array<string>": "varchar[]",
    "array<double>": "double[]",
}


def table(name: str) -> str:
    """One lookup as a common table expression."""
    return f"{name} as ({values_sql(name, array='[{}]', types=_TYPES)})"


def tables(*names: str) -> str:
    return ",\n".join(table(n) for n in names)


def draw(seed: int, row_id: str, name: str) -> str:
    key, factor = D.draw_key(seed, name)
    rid = f"({row_id})::bigint"
    x = (
        f"xor(xor({rid} & {D.MASK}, {key}),"
        f" ((({rid} >> 32) & 2147483647) * {factor}) & {D.MASK})"
    )
    for shift, mult in D.MIX_STEPS:
        x = f"((xor({x}, {x} >> {shift}) * {mult}) & {D.MASK})"
    return f"(xor({x}, {x} >> {D.MIX_LAST})::double / 4294967296.0::double)"


def wobble(seed: int, row_id: str, name: str = "wobble") -> str:
    cells = [
        f"(floor({draw(seed, row_id, f'{name}{m}')} * 20.0::double + 0.5::double) + 90) / 100.0::double"
        for m in range(1, 13)
    ]
    return f"[{', '.join(cells)}]"


def cents(x: str) -> str:
    return f"cast(floor(({x}) * 100.0::double + 0.5::double)::decimal(12,0) * 0.01 as decimal(10,2))"


def triangular(u: str, low: str, mode: str, high: str) -> str:
    return (
        f"case when {u} < ({mode}-{low})/({high}-{low})"
        f" then {low} + sqrt({u}*({high}-{low})*({mode}-{low}))"
        f" else {high} - sqrt((1-{u})*({high}-{low})*({high}-{mode})) end"
    )


def season(department: str, category: str, subcategory: str) -> str:
    s = f"lower({subcategory})"
    return f"""case when {s} like '%ice cream%' or {s} like '%frozen dessert%' then 'ice_cream'
      when {s} like '%soup%' or lower({category}) like '%soup%' then 'soup'
      when {s} like '%bbq%' or {s} like '%sausage%' or {subcategory} = 'Bacon' then 'barbecue'
      when {s} like '%confectionery%' or {s} like '%chocolate%' then 'easter'
      when {department} = 'Alcohol' and {s} like '%sparkling%' then 'christmas' end"""


def season_vector(pattern: str, other: str) -> str:
    whens = " ".join(
        f"when {pattern} = '{n}' then {[float(x) for x in v]}::double[]"
        for n, v in values.seasons().items()
    )
    return f"case {whens} else {other} end"


# Product rows over part: k, p_size, department ... retail. Money as decimal(10,2).
PARTS = f"""{tables("department", "taxonomy", "gst_free", "shelf_life")},
part_base as (
  select p_partkey k, p_size, p_brand brand, d.dept_no, d.department, d.margin,
    t.category, t.subcategory, {season("d.department", "t.category", "t.subcategory")} season,
    not exists (select 1 from gst_free g where g.department = d.department
                and (g.category is null or g.category = t.category)) gst_applicable,
    case when d.department = 'Fresh Produce' then (p_partkey % 28 + 3)::double
      when d.department in ('Bakery','Dairy','Meat & Seafood','Frozen')
      then s.shelf_life_days end shelf_life_days,
    case when d.department = 'Fresh Produce' then 0.06::double
      when d.department in ('Bakery','Dairy','Meat & Seafood','Frozen')
      then s.wastage_rate end wastage_rate_baseline,
    p_partkey % 5 = 0 and d.department <> 'Fresh Produce' is_private_label,
    cast(0.30 + 0.40 * p_size + 0.01 * (p_partkey % 100) as decimal(10,2)) cost,
    cast(case p_partkey % 4 when 0 then 0.49 when 1 then 0.79 when 2 then 0.95 else 0.99 end
      as decimal(10,2)) ending
  from part join department d on d.dept_no = p_size % 10
  join taxonomy t on t.dept_no = d.dept_no and t.flat_no = p_partkey % d.n_subcategories
  left join shelf_life s on s.category = t.category),
part_charm as (
  select *, cast(case when cost * (1 + margin) < 1 then ending
    else floor(cost * (1 + margin)) + ending end as decimal(10,2)) charm from part_base),
parts as (
  select *, cast(case when charm > cost then charm when cost < 0.49 then 0.49
    when cost < 0.79 then 0.79 when cost < 0.95 then 0.95 when cost < 0.99 then 0.99
    else floor(cost) + 1.49 end as decimal(10,2)) retail from part_charm)"""

# The layer columns most checks need, with silver types.
SILVER = f"""{PARTS},
silver as (
  select printf('P%06d', k) product_id,
    printf('%013d', k + case when department = 'Fresh Produce' then 2000000 else 3000000 end) sku,
    brand || ' ' || subcategory as name, department, category, subcategory, brand, is_private_label,
    case when department = 'Pantry' then 'g' else 'each' end unit_of_measure,
    cast(case when department = 'Pantry' then 375 else 1 end as decimal(10,3)) pack_size,
    cost cost_price_aud, retail retail_price_aud, gst_applicable, shelf_life_days,
    wastage_rate_baseline, printf('SUP%04d', k % 60 + 1) supplier_id, season, k
  from parts)"""

MARGIN = (
    "cast((retail_price_aud - cost_price_aud) / retail_price_aud * 100 as decimal(5,2))"
)
TIER = (
    "case when retail_price_aud < 5 then 'Budget' when retail_price_aud < 20 then 'Mid'"
    " else 'Premium' end"
)
# No fresh season pattern exists, and fresh rows get their vector from the wobble here.
GOLD = f"""{SILVER},
gold as (
  select *, shelf_life_days is not null is_perishable, season is not null is_seasonal,
    {TIER} price_tier, {MARGIN} margin_pct from silver)"""
