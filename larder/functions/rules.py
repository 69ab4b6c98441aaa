"""Business rules of the product dimension."""

from __future__ import annotations

from collections.abc import Sequence

from larder import values
from larder.functions import draws

MONEY = "decimal(10,2)"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(column: str, options: Sequence[str]) -> str:
    return f"{column} in ({', '.join(_text(o) for o in options)})"


def _has(text: str, *words: str) -> str:
    return "(" + " or ".join(f"contains({text}, {_text(w)})" for w in words) + ")"


def format_key(prefix: str, n: str, width: int) -> str:
    """Prefix and zero-padded number such as ``P000042``; longer numbers keep all their digits."""
    digits = f"cast(cast({n} as bigint) as string)"
    padded = f"lpad({digits}, greatest(length({digits}), {width}), '0')"
    return f"concat({_text(prefix)}, {padded})" if prefix else padded


# ---- prices ------------------------------------------------------------------------------------


def price_ending(u: str) -> str:
    """One of the four price endings as decimal."""
    no = draws.uniform_int(u, len(values.PRICE_ENDINGS))
    whens = " ".join(f"when {i} then {e}BD" for i, e in enumerate(values.PRICE_ENDINGS))
    return f"cast(case {no} {whens} end as {MONEY})"


def markup_price(cost: str, margin: str, jitter: str) -> str:
    """Raw retail price before the ending is set, as double."""
    return f"(cast({cost} as double) * (1D + cast({margin} as double)) * {jitter})"


def charm_price(price: str, ending: str) -> str:
    """Whole dollars of ``price`` plus the ending; below one dollar just the ending."""
    dollars = f"cast(floor({price}) as decimal(9,0))"
    return f"cast(case when {price} < 1 then {ending} else {dollars} + {ending} end as {MONEY})"


def retail_above_cost(retail: str, cost: str) -> str:
    """Keep ``retail`` when it exceeds ``cost``, else move up to the next price that does."""
    whens = " ".join(f"when {cost} < {e}BD then {e}BD" for e in values.PRICE_ENDINGS)
    dollars = f"cast(floor({cost}) as decimal(9,0))"
    return (
        f"cast(case when {retail} > {cost} then {retail} {whens}"
        f" else {dollars} + 1.49BD end as {MONEY})"
    )


def price_tier(retail: str) -> str:
    """Budget below 5, Mid below 20, else Premium (a missing price counts as Premium)."""
    return f"case when {retail} < 5 then 'Budget' when {retail} < 20 then 'Mid' else 'Premium' end"


def margin_pct(retail: str, cost: str) -> str:
    """Margin in percent of retail; NULL for a zero price or a value out of range."""
    return f"try_cast(try_divide({retail} - {cost}, {retail}) * 100 as decimal(5,2))"


# ---- packs and names ---------------------------------------------------------------------------


def unit_and_pack(department: str, subcategory: str, u: str) -> tuple[str, str]:
    """(unit of measure, pack size); the first matching rule wins."""
    drinks = _in(department, ("Beverages", "Alcohol", "Dairy"))
    rules = [
        (f"{drinks} and {_has(subcategory, 'Water', 'Juice', 'Milk')}", "L", values.LITRE_PACKS),
        (f"{drinks} and {_has(subcategory, 'Spirits', 'Wine', 'Whisky')}", "mL", (700.0,)),
        (f"{department} = 'Meat & Seafood'", "kg", values.MEAT_PACKS),
        (_in(department, ("Health & Beauty", "Household")), "mL", values.CARE_PACKS),
        (f"{department} = 'Pantry'", "g", values.PANTRY_PACKS),
        (f"{department} = 'Frozen'", "g", values.FROZEN_PACKS),
    ]
    unit = " ".join(f"when {cond} then '{unit}'" for cond, unit, _ in rules)
    pack = " ".join(f"when {cond} then {draws.choice_of(u, sizes)}" for cond, _, sizes in rules)
    return f"case {unit} else 'each' end", f"case {pack} else 1D end"


def pack_label(unit: str, size: str) -> str:
    """``500g``, ``1.25L``, ``250pk``; empty for single items."""
    size = f"cast({size} as double)"
    number = (
        f"case when {size} = floor({size}) then cast(cast({size} as bigint) as string)"
        f" else cast({size} as string) end"
    )
    suffix = f"case when {unit} = 'pack' then 'pk' else {unit} end"
    return f"case when {unit} = 'each' then '' else concat({number}, {suffix}) end"


def bag_label(size: str) -> str:
    """``2kg bag`` from one kilogram on (whole kilograms only), grams below."""
    return (
        f"case when {size} >= 1 then concat(cast(cast(floor({size}) as bigint) as string), 'kg bag')"
        f" else concat(cast(cast(floor({size} * 1000) as bigint) as string), 'g bag') end"
    )


def product_name(brand: str, base: str, label: str) -> str:
    """Brand, base and label with single blanks between the parts that are there."""
    return f"concat_ws(' ', nullif({brand}, ''), nullif({base}, ''), nullif({label}, ''))"


def brand_pick(is_private_label: str, u: str, pool: str) -> str:
    """The private-label brand when drawn, else a brand of the pool."""
    own = _text(values.PRIVATE_LABEL_BRAND)
    return f"case when {is_private_label} then {own} else {draws.choice(u, pool)} end"


def fresh_brand(u: str, rate: str, pool: str) -> str:
    """Fresh goods draw the private-label brand too, but are never flagged as private label and
    otherwise always carry the first brand of the pool."""
    own = _text(values.PRIVATE_LABEL_BRAND)
    return f"case when {draws.bernoulli(u, rate)} then {own} else element_at({pool}, 1) end"


# ---- seasonality -------------------------------------------------------------------------------


def vector_literal(v: Sequence[float]) -> str:
    return f"array({', '.join(f'{float(x)!r}D' for x in v)})"


def flat_vector() -> str:
    return "array_repeat(1D, 12)"


def wobble_draws(name: str = "wobble") -> list[str]:
    """Names of the twelve draws behind a wobble vector."""
    return [f"{name}{m}" for m in range(1, 13)]


def wobble_vector(us: Sequence[str], amplitude: float = 0.1) -> str:
    """Vector of 1 +/- amplitude from uniform draws, two decimals each."""
    low = round(100 * (1 - amplitude))
    width = round(200 * amplitude)
    return f"transform(array({', '.join(us)}), u -> (floor(u * {width}D + 0.5D) + {low}) / 100D)"


def season_name(department: str, category: str, subcategory: str) -> str:
    """Name of the season pattern, NULL when only a wobble applies; the first match wins."""
    sub, cat = f"lower({subcategory})", f"lower({category})"
    return (
        f"case when {_has(sub, 'ice cream', 'frozen dessert')} then 'ice_cream'"
        f" when {_has(sub, 'soup')} or {_has(cat, 'soup')} then 'soup'"
        f" when {_has(sub, 'bbq', 'sausage')} or {subcategory} = 'Bacon' then 'barbecue'"
        f" when {_has(sub, 'confectionery', 'chocolate')} then 'easter'"
        f" when {department} = 'Alcohol' and {_has(sub, 'sparkling')} then 'christmas' end"
    )


def season_vector(pattern: str, wobble: str) -> str:
    """Vector of the named pattern, else the wobble."""
    whens = " ".join(
        f"when {pattern} = '{name}' then {vector_literal(v)}"
        for name, v in values.seasons().items()
    )
    return f"case {whens} else {wobble} end"


def peak_months(vector: str, threshold: float = values.PEAK_THRESHOLD) -> str:
    """1-based positions whose value reaches the threshold, in order; any vector length."""
    marked = (
        f"transform({vector}, (x, i) -> if(x >= {float(threshold)!r}D, cast(i as bigint) + 1, null))"
    )
    return f"filter({marked}, p -> p is not null)"


def vector_ok(vector: str, length: int = 12) -> str:
    """Right length and no negative value; a missing vector is not ok."""
    return f"coalesce(size({vector}) = {length} and forall({vector}, x -> x >= 0), false)"
