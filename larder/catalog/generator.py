"""Draws, rules and the product build over rows of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import values
from larder.catalog import check_sql as S
from larder.catalog import query
from larder.functions import draws as D
from larder.functions import rules as R
from larder.lookups import Lookups
from larder.operators.allocate import allocate, expand
from larder.operators.enrich import lookup, with_gst_flag, with_perishability
from larder.plans.builder import fresh_cost, fresh_specs, products_for, supplier_pools
from larder.plans.part_products import read_part_products

SEED = 42
PICKED = ("supplier1", "supplier2", "supplier3", "suppliers")


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


def _u(name: str, row_id: str = "k") -> str:
    """The draw of a row in the check SQL."""
    return S.draw(SEED, row_id, name)


def _drawn(df: DataFrame, *names: str, row_id: str = "k") -> DataFrame:
    return D.with_draws(df, SEED, row_id, names)


def _text(v: str) -> str:
    return f"array_join(transform({v}, x -> cast(x as string)), ',')"


def _text_sql(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x: x::varchar), ',')"


# ---- allocation --------------------------------------------------------------------------------


def _allocation_sql(weights: str, total: str, tie: str) -> str:
    """Adds n to the relation ``weights`` (columns weight and the tie)."""
    return f"""select * exclude (fl, rn, fls), (fl + case when rn <= {total} - fls then 1 else 0 end)::bigint n
      from (select *, sum(fl) over () fls,
              row_number() over (order by weight::hugeint * {total} % w desc, {tie}) rn
            from (select *, (weight::hugeint * {total} // w) fl
                  from (select *, (sum(weight) over ())::hugeint w from {weights})))"""


@query(
    "allocate_largest_remainder",
    f"""with sold as (select p_brand, sum(l_quantity)::bigint weight
          from lineitem join part on l_partkey = p_partkey group by p_brand)
        select p_brand, weight, n from ({
        _allocation_sql("sold", "(select count(*) from part)", "p_brand")})""",
)
def allocate_largest_remainder(spark, sf_dir):
    """Shelf rows (as many as parts) split over brands by what they sold."""
    part = _part(spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    per_part = lines.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    sold = (
        per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(F.sum("qty").cast("bigint").alias("weight"))
    )
    total = part.agg(F.count("*")).scalar()
    return allocate(sold, total, tie="p_brand").select("p_brand", "weight", "n")


_DEPT_ALLOC = f"""alloc as ({_allocation_sql("department", "(select count(*) from part)", "alloc_no")}),
bounds as (select *, sum(n) over (order by dept_no)::bigint hi,
    (sum(n) over (order by dept_no) - n)::bigint lo from alloc)"""


@query(
    "expand_allocation",
    f"""with {S.table("department")}, {_DEPT_ALLOC}
        select p_partkey, dept_no, p_partkey + 1 - lo as in_dept
        from part join bounds on p_partkey + 1 > lo and p_partkey + 1 <= hi""",
)
def expand_allocation(spark, sf_dir):
    part = _part(spark, sf_dir)
    total = part.agg(F.count("*")).scalar()
    allocation = allocate(Lookups.builtin(spark).table("department"), total)
    numbered = part.selectExpr("p_partkey", "p_partkey + 1 as number")
    out = expand(numbered, "number", allocation)
    return out.selectExpr("p_partkey", "dept_no", "in_group as in_dept")


# ---- draws -------------------------------------------------------------------------------------


@query(
    "draw_choice",
    f"""with {S.PARTS}, drawn as (select parts.k, brands, {_u("brand", "parts.k")} u from parts
          join department using (department))
        select k, brands[floor(u * len(brands))::int + 1] picked from drawn""",
)
def draw_choice(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).select("k", "department")
    brands = Lookups.builtin(spark).table("department").select("department", "brands")
    rows = _drawn(rows.join(brands, "department"), "brand")
    return rows.selectExpr("k", f"{D.choice('u_brand', 'brands')} as picked")


@query(
    "draw_uniform",
    f"select o_orderkey, 0.95::double + 0.1::double * {_u('jitter', 'o_orderkey')} jitter from orders",
)
def draw_uniform(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    rows = _drawn(orders, "jitter", row_id="o_orderkey")
    # 1.05 - 0.95 is not 0.1 in binary, so the width is given as such.
    return rows.selectExpr("o_orderkey", "0.95D + 0.1D * u_jitter as jitter")


@query(
    "draw_triangular",
    f"""with {S.PARTS}, drawn as (select parts.k, d.*, {_u("cost", "parts.k")} u
          from parts join department d using (department))
        select k, {S.cents(S.triangular("u", "cost_low", "cost_mode", "cost_high"))} as drawn_cost
        from drawn""",
)
def draw_triangular(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).select("k", "department")
    dept = Lookups.builtin(spark).table("department")
    rows = _drawn(rows.join(dept, "department"), "cost")
    cost = D.to_cents(D.triangular("u_cost", "cost_low", "cost_mode", "cost_high"))
    return rows.selectExpr("k", f"{cost} as drawn_cost")


@query(
    "draw_int",
    f"select c_custkey, floor({_u('spec', 'c_custkey')} * 20)::int picked from customer",
)
def draw_int(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    rows = _drawn(rows, "spec", row_id="c_custkey")
    return rows.selectExpr("c_custkey", f"{D.uniform_int('u_spec', 20)} as picked")


@query(
    "draw_bernoulli",
    f"""with {S.PARTS} select parts.k, {_u("private_label", "parts.k")} < private_label_rate private
        from parts join department using (department)""",
)
def draw_bernoulli(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).select("k", "department")
    rows = _drawn(rows.join(Lookups.builtin(spark).table("department"), "department"), "private_label")
    return rows.selectExpr(
        "k", f"{D.bernoulli('u_private_label', 'private_label_rate')} as private"
    )


def _picks_sql(source: str, key: str, pool: str, seed: int, keep: str) -> str:
    """The columns ``keep`` plus the picks array of every key."""
    u = [S.draw(seed, key, n) for n in PICKED]
    return f"""select {keep}, list_slice([p0, p1, p2 + (p2 >= greatest(p0, p1))::bigint], 1, cnt) suppliers
      from (select * replace (p2 + (p2 >= least(p0, p1))::bigint as p2)
        from (select * replace (p1 + (p1 >= p0)::bigint as p1)
          from (select *, floor({u[0]} * {pool})::bigint + 1 p0,
                  floor({u[1]} * ({pool} - 1))::bigint + 1 p1,
                  floor({u[2]} * ({pool} - 2))::bigint + 1 p2,
                  floor({u[3]} * 3)::int + 1 cnt from {source})))"""


@query(
    "sample_suppliers",
    f"""with picked as ({
        _picks_sql("part", "p_partkey", "(select count(*) from supplier)", SEED, "p_partkey")
    }), flat as (select p_partkey, unnest(suppliers) - 1 s_suppkey from picked)
    select p_partkey, s_suppkey, s_name from flat join supplier using (s_suppkey)""",
)
def sample_suppliers(spark, sf_dir):
    """1 to 3 different suppliers of the supplier table for every part."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    keys = _part(spark, sf_dir).select(
        "p_partkey", supplier.agg(F.count("*")).scalar().alias("n_pool")
    )
    picked = supplier_pools(keys, "p_partkey", pool="n_pool", seed=SEED)
    # Exploding the pick numbers keeps the picks one column; exploding the picks themselves would
    # let the optimizer repeat their whole expression in inferred filters.
    flat = picked.selectExpr("p_partkey", "suppliers", "explode(array(1, 2, 3)) as pick_no")
    flat = flat.filter("pick_no <= size(suppliers)")
    flat = flat.selectExpr("p_partkey", "element_at(suppliers, pick_no) - 1 as s_suppkey")
    return flat.join(supplier, "s_suppkey").select("p_partkey", "s_suppkey", "s_name")


_FRESH_COST = S.cents(
    "cost::double * pack * (0.9::double + 0.20000000000000007::double * u_cost)"
)
_BAG_SQL = (
    "case when {0} >= 1 then floor({0})::int::varchar || 'kg bag'"
    " else floor({0} * 1000)::int::varchar || 'g bag' end"
)


@query(
    "fresh_variants",
    f"""with {S.table("fresh")}, drawn as (select p_partkey k,
          case when p_partkey < 20 then p_partkey else floor({_u("spec", "p_partkey")} * 20) end::int spec,
          ([0.5, 1.0, 1.5, 2.0]::double[])[floor({_u("fresh_pack", "p_partkey")} * 4)::int + 1] pack,
          {_u("fresh_cost", "p_partkey")} u_cost from part)
        select k, case when k < 20 then name else name || ' ' || {_BAG_SQL.format("pack")} end as item,
          case when k < 20 then pack_size else pack end as pack_size,
          case when k < 20 then unit_of_measure else 'kg' end as unit_of_measure,
          case when k < 20 then cost else greatest({_FRESH_COST}, 0.50::decimal(10,2)) end as item_cost
        from drawn join fresh on spec_no = spec""",
)
def fresh_variants(spark, sf_dir):
    """The first 20 parts become the curated goods, all others variants of one of them."""
    lookups = Lookups.builtin(spark)
    n = lookups.rows("fresh")
    rows = _drawn(_part(spark, sf_dir).selectExpr("p_partkey as k"), "spec", "fresh_pack", "fresh_cost")
    rows = rows.selectExpr("*", f"{D.choice_of('u_fresh_pack', values.FRESH_PACKS)} as bag")
    spec = f"if(k < {n}, cast(k as int), {D.uniform_int('u_spec', n)})"
    rows = lookup(rows, F.broadcast(fresh_specs(lookups)), {"spec_no": spec})
    return rows.selectExpr(
        "k",
        f"if(k < {n}, spec_name, concat_ws(' ', spec_name, {R.bag_label('bag')})) as item",
        f"if(k < {n}, spec_pack, bag) as pack_size",
        f"if(k < {n}, spec_unit, 'kg') as unit_of_measure",
        f"if(k < {n}, spec_cost, {fresh_cost('bag', 'spec_cost', 'u_fresh_cost')}) as item_cost",
    )


# Numbers around a million, where a padded key grows to seven digits.
@query(
    "format_keys",
    """select p_partkey, printf('P%06d', p_partkey + 999000) product_id,
         printf('%013d', p_partkey + 3000000) sku, printf('SUP%04d', p_partkey % 60 + 1) supplier_id
       from part""",
)
def format_keys(spark, sf_dir):
    return _part(spark, sf_dir).selectExpr(
        "p_partkey",
        f"{R.format_key('P', 'p_partkey + 999000', 6)} as product_id",
        f"{R.format_key('', 'p_partkey + 3000000', 13)} as sku",
        f"{R.format_key('SUP', 'p_partkey % 60 + 1', 4)} as supplier_id",
    )


@query(
    "sort_by_key",
    """select p_partkey as number, printf('P%06d', p_partkey + 999000) product_id from part
       order by p_partkey""",
)
def sort_by_key(spark, sf_dir):
    """In the order of the running number: as text P1000000 would come before P999999."""
    rows = _part(spark, sf_dir).selectExpr(
        "p_partkey as number", f"{R.format_key('P', 'p_partkey + 999000', 6)} as product_id"
    )
    return rows.orderBy("number")


# ---- rules -------------------------------------------------------------------------------------


@query("charm_price", f"with {S.PARTS} select k, cost, charm from parts")
def charm_price(spark, sf_dir):
    return read_part_products(spark, sf_dir).select("k", "cost", "charm")


@query("retail_above_cost", f"with {S.PARTS} select k, charm, retail from parts")
def retail_above_cost(spark, sf_dir):
    return read_part_products(spark, sf_dir).select("k", "charm", "retail")


@query(
    "markup_price",
    f"""with {S.PARTS}, drawn as (select k, cost, margin,
          case when department = 'Fresh Produce' then 0.95::double + 0.10000000000000009::double * {_u("jitter")}
          else 0.97::double + 0.06000000000000005::double * {_u("jitter")} end jitter from parts)
        select k, cost::double * (1 + margin::double) * jitter as raw_retail from drawn""",
)
def markup_price(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).select("k", "department", "cost", "margin")
    rows = _drawn(rows, "jitter").selectExpr(
        "*",
        f"if(department = 'Fresh Produce', {D.uniform_real('u_jitter', 0.95, 1.05)},"
        f" {D.uniform_real('u_jitter', 0.97, 1.03)}) as jitter",
    )
    return rows.selectExpr("k", f"{R.markup_price('cost', 'margin', 'jitter')} as raw_retail")


@query("gst_flag", f"with {S.PARTS} select k, department, category, gst_applicable from parts")
def gst_flag(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).select("k", "department", "category")
    return with_gst_flag(rows, Lookups.builtin(spark).table("gst_free"))


@query(
    "perishability",
    f"""with {S.PARTS} select k, department, category,
        case when department in ('Fresh Produce','Bakery','Dairy','Meat & Seafood','Frozen')
          then s.shelf_life_days end as shelf_life_days,
        case when department in ('Fresh Produce','Bakery','Dairy','Meat & Seafood','Frozen')
          then s.wastage_rate end as wastage_rate_baseline
        from parts left join shelf_life s using (category)""",
)
def perishability(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).select("k", "department", "category")
    return with_perishability(rows, Lookups.builtin(spark).table("shelf_life"))


def _unit_sql(dept: str, sub: str) -> str:
    drinks = f"{dept} in ('Beverages','Alcohol','Dairy')"
    return f"""case when {drinks} and regexp_matches({sub}, 'Water|Juice|Milk') then 'L'
      when {drinks} and regexp_matches({sub}, 'Spirits|Wine|Whisky') then 'mL'
      when {dept} = 'Meat & Seafood' then 'kg' when {dept} in ('Health & Beauty','Household') then 'mL'
      when {dept} in ('Pantry','Frozen') then 'g' else 'each' end"""


def _pack_sql(dept: str, sub: str, u: str) -> str:
    drinks = f"{dept} in ('Beverages','Alcohol','Dairy')"

    def pick(pool) -> str:
        return f"({[float(p) for p in pool]}::double[])[floor({u} * {len(pool)})::int + 1]"

    return f"""case when {drinks} and regexp_matches({sub}, 'Water|Juice|Milk')
        then {pick((0.5, 1, 1.25, 2))}
      when {drinks} and regexp_matches({sub}, 'Spirits|Wine|Whisky') then 700
      when {dept} = 'Meat & Seafood' then {pick((0.3, 0.4, 0.5, 1, 1.5))}
      when {dept} in ('Health & Beauty','Household') then {pick((100, 150, 200, 400, 500, 750, 1000))}
      when {dept} = 'Pantry' then {pick((200, 250, 375, 500, 750, 1000))}
      when {dept} = 'Frozen' then {pick((300, 400, 500, 600, 800))} else 1 end::double"""


def _label_sql(unit: str, size: str) -> str:
    return f"""case when {unit} = 'each' then '' else
      (case when {size} = floor({size}) then {size}::bigint::varchar else {size}::varchar end)
      || (case when {unit} = 'pack' then 'pk' else {unit} end) end"""


_PACKED = f"""{S.PARTS}, drawn as (select *, {_u("pack")} u from parts),
packed as (select *, {_unit_sql("department", "subcategory")} as unit,
  {_pack_sql("department", "subcategory", "u")} as pack from drawn)"""


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_part_products(spark, sf_dir).select("k", "department", "subcategory", "brand")
    unit, pack = R.unit_and_pack("department", "subcategory", "u_pack")
    return _drawn(rows, "pack").selectExpr("*", f"{unit} as unit", f"{pack} as pack")


@query("unit_and_pack", f"with {_PACKED} select k, department, subcategory, unit, pack from packed")
def unit_and_pack(spark, sf_dir):
    return _packed(spark, sf_dir).select("k", "department", "subcategory", "unit", "pack")


# Every seventh row is counted in packs.
@query(
    "pack_label",
    f"""with {_PACKED}, units as (select k, case when k % 7 = 0 then 'pack' else unit end as unit, pack
          from packed) select k, unit, pack, {_label_sql("unit", "pack")} as label from units""",
)
def pack_label(spark, sf_dir):
    rows = _packed(spark, sf_dir).selectExpr("k", "if(k % 7 = 0, 'pack', unit) as unit", "pack")
    return rows.selectExpr("k", "unit", "pack", f"{R.pack_label('unit', 'pack')} as label")


def _base_sql(u: str, templates: str, sub: str) -> str:
    return f"coalesce({templates}[floor({u} * len({templates}))::int + 1], {sub})"


def _name_sql(brand: str, base: str, label: str) -> str:
    return f"concat_ws(' ', nullif({brand}, ''), nullif({base}, ''), nullif({label}, ''))"


@query(
    "product_name",
    f"""with {_PACKED}, {S.table("name_template")},
        named as (select packed.*, templates, {_u("template")} ut from packed
          left join name_template using (subcategory))
        select k, {_name_sql("brand", _base_sql("ut", "templates", "subcategory"),
                             _label_sql("unit", "pack"))} as name from named""",
)
def product_name(spark, sf_dir):
    rows = _drawn(_packed(spark, sf_dir), "template")
    templates = Lookups.builtin(spark).table("name_template")
    rows = lookup(rows, templates, {"subcategory": "subcategory"}, "left")
    base = f"coalesce({D.choice('u_template', 'templates')}, subcategory)"
    name = R.product_name("brand", base, R.pack_label("unit", "pack"))
    return rows.selectExpr("k", f"{name} as name")


@query(
    "bag_label",
    f"select p_partkey, p_size / 4.0::double as size, {_BAG_SQL.format('(p_size / 4.0::double)')} as bag from part",
)
def bag_label(spark, sf_dir):
    rows = _part(spark, sf_dir).selectExpr("p_partkey", "p_size / 4D as size")
    return rows.selectExpr("*", f"{R.bag_label('size')} as bag")


@query(
    "brand_pick",
    f"""with {S.PARTS}, drawn as (select k, department, brands, private_label_rate rate,
          {_u("private_label")} up, {_u("brand")} ub from parts join department using (department))
        select k, department, department <> 'Fresh Produce' and up < rate private,
          case when department = 'Fresh Produce' then case when ub < rate then 'Generic' else brands[1] end
            when up < rate then 'Generic' else brands[floor(ub * len(brands))::int + 1] end picked
        from drawn""",
)
def brand_pick(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).select("k", "department")
    dept = Lookups.builtin(spark).table("department").select("department", "brands", "private_label_rate")
    rows = _drawn(rows.join(dept, "department"), "private_label", "brand")
    private = D.bernoulli("u_private_label", "private_label_rate")
    fresh = "department = 'Fresh Produce'"
    return rows.selectExpr(
        "k", "department",
        f"not {fresh} and {private} as private",
        f"if({fresh}, {R.fresh_brand('u_brand', 'private_label_rate', 'brands')},"
        f" {R.brand_pick(private, 'u_brand', 'brands')}) as picked",
    )


@query(
    "category_seasonality",
    f"""with {S.PARTS} select k, season,
        {_text_sql(S.season_vector("season", S.wobble(7, "k")))} as months from parts""",
)
def category_seasonality(spark, sf_dir):
    rows = read_part_products(spark, sf_dir)
    return rows.selectExpr("k", "season", f"{_text('seasonality_vector')} as months")


@query(
    "peak_months",
    """select vec_id, array_to_string(list_filter(list_transform(embedding,
         lambda x, i: case when x::double >= 0.2::double then i end), lambda p: p is not null), ',') peaks
       from embeddings""",
)
def peak_months(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.selectExpr(
        "vec_id", f"array_join({R.peak_months('embedding', 0.2)}, ',') as peaks"
    )


@query(
    "validate_vector",
    """select vec_id, len(embedding) = 64 and len(list_filter(embedding, lambda x: x < 0)) = 0 as raw_ok,
         len(embedding) = 64 as magnitude_ok, len(embedding) = 12 as as_months_ok from embeddings""",
)
def validate_vector(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    sizes = "transform(embedding, x -> abs(x))"
    return vectors.selectExpr(
        "vec_id",
        f"{R.vector_ok('embedding', 64)} as raw_ok",
        f"{R.vector_ok(sizes, 64)} as magnitude_ok",
        f"{R.vector_ok(sizes)} as as_months_ok",
    )


@query(
    "wobble_vector",
    f"""select p_partkey, {_text_sql(S.wobble(SEED, "p_partkey"))} wobble,
        {_text_sql("[1.0::double for m in range(12)]")} flat from part""",
)
def wobble_vector(spark, sf_dir):
    names = R.wobble_draws()
    rows = _drawn(_part(spark, sf_dir).select("p_partkey"), *names, row_id="p_partkey")
    vector = R.wobble_vector([f"u_{n}" for n in names])
    return rows.selectExpr(
        "p_partkey", f"{_text(vector)} as wobble", f"{_text(R.flat_vector())} as flat"
    )


@query(
    "taxonomy_lookup",
    f"""with {S.PARTS} select department, category, subcategory, count(*) n_products, min(margin) margin
        from parts group by department, category, subcategory""",
)
def taxonomy_lookup(spark, sf_dir):
    rows = read_part_products(spark, sf_dir)
    return rows.groupBy("department", "category", "subcategory").agg(
        F.count("*").alias("n_products"), F.min("margin").alias("margin")
    )


# ---- the whole build ---------------------------------------------------------------------------

_BUILD = f"""{S.tables("department", "category", "gst_free", "shelf_life", "fresh", "name_template")},
{_DEPT_ALLOC},
pools as ({_picks_sql("category", "cat_id", "60", 0, "dept_no, cat_no, category, subcategories")}),
specs as (select f.*, c.cat_no spec_cat_no, coalesce(months, {S.wobble(0, "spec_no")}) spec_vector
  from fresh f join category c on c.department = 'Fresh Produce' and c.category = f.category),
numbered as (select p_partkey + 1 as k, p_partkey + 1 - lo in_dept, dept_no, department, margin,
    cost_low, cost_mode, cost_high, private_label_rate rate, brands, n_categories,
    department = 'Fresh Produce' is_fresh,
    department = 'Fresh Produce' and p_partkey + 1 - lo <= 20 is_curated
  from part join bounds on p_partkey + 1 > lo and p_partkey + 1 <= hi),
placed as (select n.*, s.spec_cat_no, s.spec_vector, s.name spec_name, s.subcategory spec_sub,
    s.unit_of_measure spec_unit, s.pack_size spec_pack, s.cost, s.shelf_life_days spec_life,
    s.wastage_rate spec_waste, {_u("fresh_cost")} u_cost,
    ([0.5, 1.0, 1.5, 2.0]::double[])[floor({_u("fresh_pack")} * 4)::int + 1] pack, {_u("cost")} uc
  from numbered n left join specs s on s.spec_no = case when is_curated then in_dept - 1
    when is_fresh then floor({_u("spec")} * 20)::int end),
chosen as (select p.* exclude (cost), q.category, q.suppliers,
    case when is_fresh then spec_sub
      else q.subcategories[floor({_u("subcategory")} * len(q.subcategories))::int + 1] end as subcategory,
    not is_fresh and {_u("private_label")} < rate as is_private_label, {_u("brand")} ub,
    case when is_curated then p.cost when is_fresh then greatest({_FRESH_COST}, 0.50::decimal(10,2))
      else {S.cents(S.triangular("uc", "cost_low", "cost_mode", "cost_high"))} end as cost_price,
    case when is_fresh then 0.95::double + 0.10000000000000009::double * {_u("jitter")}
      else 0.97::double + 0.06000000000000005::double * {_u("jitter")} end jitter,
    ([0.49, 0.79, 0.95, 0.99]::decimal(10,2)[])[floor({_u("ending")} * 4)::int + 1] ending
  from placed p join pools q on q.dept_no = p.dept_no
    and q.cat_no = coalesce(spec_cat_no, floor({_u("category")} * n_categories)::int)),
priced as (select *, cost_price::double * (1 + margin::double) * jitter as markup,
    {_u("pack")} up, case when not is_fresh then {S.season("department", "category", "subcategory")} end as season
  from chosen),
charmed as (select *, cast(case when markup < 1 then ending else floor(markup)::decimal(9,0) + ending end
    as decimal(10,2)) charm,
    case when is_curated then spec_unit when is_fresh then 'kg'
      else {_unit_sql("department", "subcategory")} end as unit_of_measure,
    case when is_curated then spec_pack when is_fresh then pack
      else {_pack_sql("department", "subcategory", "up")} end as pack_size,
    case when is_fresh then case when ub < rate then 'Generic' else brands[1] end
      when is_private_label then 'Generic' else brands[floor(ub * len(brands))::int + 1] end as brand,
    case when is_fresh then spec_vector
      else {S.season_vector("season", S.wobble(SEED, "k"))} end as vec
  from priced)
select printf('P%06d', k) product_id,
  printf('%013d', k + case when is_fresh then 2000000 else 3000000 end) sku,
  case when is_curated then spec_name when is_fresh then spec_name || ' ' || {_BAG_SQL.format("pack")}
    else {_name_sql("brand", _base_sql(_u("template"), "templates", "subcategory"),
                    _label_sql("unit_of_measure", "pack_size"))} end as name,
  department, charmed.category, subcategory, brand, is_private_label, unit_of_measure, pack_size,
  cost_price::double cost_price_aud,
  cast(case when charm > cost_price then charm when cost_price < 0.49 then 0.49
    when cost_price < 0.79 then 0.79 when cost_price < 0.95 then 0.95 when cost_price < 0.99 then 0.99
    else floor(cost_price) + 1.49 end as decimal(10,2))::double retail_price_aud,
  not exists (select 1 from gst_free g where g.department = charmed.department
    and (g.category is null or g.category = charmed.category)) gst_applicable,
  case when is_fresh then spec_life
    when department in ('Bakery','Dairy','Meat & Seafood','Frozen') then s.shelf_life_days end as shelf_life_days,
  case when is_fresh or season is not null then array_to_string(list_filter(list_transform(vec,
    lambda x, i: case when x >= 1.2::double then i end), lambda p: p is not null), ',') end as peak_season_months,
  {_text_sql("vec")} as seasonality_vector,
  case when is_fresh then spec_waste
    when department in ('Bakery','Dairy','Meat & Seafood','Frozen') then s.wastage_rate end as wastage_rate_baseline,
  printf('SUP%04d', suppliers[floor({_u("supplier")} * len(suppliers))::int + 1]) supplier_id
from charmed left join shelf_life s on s.category = charmed.category
left join name_template using (subcategory)"""


@query("build_products", f"with {_BUILD}")
def build_products(spark, sf_dir):
    """One product per part row: numbers from 1 on, as many as there are parts."""
    part = _part(spark, sf_dir)
    total = part.agg(F.count("*")).scalar()
    ids = part.selectExpr("p_partkey + 1 as number")
    rows = products_for(ids, "number", total, SEED, Lookups.builtin(spark))
    months = "array_join(peak_season_months, ',') as peak_season_months"
    return rows.selectExpr(
        *[c for c in rows.columns if c not in ("peak_season_months", "seasonality_vector")],
        months,
        f"{_text('seasonality_vector')} as seasonality_vector",
    )
