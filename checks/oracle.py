"""The registered queries as DuckDB SQL, written from the rules and not from the Spark code.

``BLOCKS`` are common table expressions in dependency order. A query is its own final
SELECT on top of the blocks it needs.
"""

from __future__ import annotations

import re

from parvis.sources.derived import LISTINGS_SQL, SALES_SQL

# Abbreviations, way types and patterns of a French address.
NORMAL = "lower(coalesce(raw_address, ''))"
NORMAL = f"regexp_replace({NORMAL}, '[,.;:!?]', ' ', 'g')"
for short, long in [
    ("bd", "boulevard"), ("av", "avenue"), ("pl", "place"), ("st", "saint"), ("imp", "impasse"),
    ("vla", "villa"), ("che", "chemin"), ("crs", "cours"), ("pas", "passage"),
]:
    NORMAL = rf"regexp_replace({NORMAL}, '\b{short}\b', '{long}', 'g')"
NORMAL = rf"trim(regexp_replace({NORMAL}, '\s+', ' ', 'g'))"

STREET = (
    r"(?i)(\d+[a-zA-Z]?)[,\s]+((?:rue|boulevard|avenue|place|impasse|villa|chemin|voie|passage|allée|cité)"
    r"\s+[A-Za-zÀ-ÿ\s\-'']+)"
)
ZIP = r"\b(75\d{3})\b"
DISTRICT = r"(?i)(?:Paris\s+)?(\d{1,2})(?:ème|eme|er|ère|e)\s*(?:arrondissement)?"

# Model answers derived from the listings themselves.
ADDRESS_ANSWERS_SQL = """
select listing_id, case row_idx % 5
    when 0 then concat('```json\n{{"address": "', cast(1 + row_idx % 50 as string), ' rue Dupont", "zipcode": 75012}}\n```')
    when 1 then '{{"address": null}}'
    when 2 then concat('{{"address": "', cast(1 + row_idx % 50 as string), ' rue Durand"}}')
    when 3 then 'no address in this text'
    else concat('  {{"address": "quai ', listing_id, '", "zipcode": null}}  ') end as response_text
from {listings}
"""

MEMO_ANSWERS_SQL = """
select listing_id, case row_idx % 4
    when 0 then concat('```json{{"executive_summary": "Summary of ', listing_id, '", "valuation_section": "V", ',
      '"market_context": "M", "risk_factors": "R", "recommendation": "HOLD"}}```')
    when 1 then concat('{{"executive_summary": "Only a summary of ', listing_id, '"}}')
    when 2 then 'sorry'
    else concat('{{"recommendation": "BUY", "risk_factors": "r", "market_context": "m", "valuation_section": "v", ',
      '"executive_summary": "', source, '", "other": 1}}') end as response_text
from {listings}
"""

# Sales as text, some with fields that cannot be read.
DIRTY_SALES_SQL = """
select id_mutation, case when unreadable_date then '30/02/2024' else cast(date_mutation as string) end as date_mutation,
  code_postal, type_local, case when unreadable_surface then 'forty' else cast(surface_reelle_bati as string) end as surface_reelle_bati,
  valeur_fonciere, nombre_pieces_principales, unreadable_date, unreadable_surface
from (select *, code_postal % 7 = 3 as unreadable_date, cast(floor(surface_reelle_bati) as int) % 11 = 4 as unreadable_surface from {sales})
"""

# Listings that lost their zip along with their address, so that some stay without any.
UNPLACED_SQL = """
select row_idx, listing_id, raw_address, description,
  case when raw_address = '' then cast(null as int) else code_postal end as code_postal,
  surface_m2, asking_price, source, pricing_bias
from {listings}
"""

EXTRACT = rf"""
  select l.*,
    regexp_extract(coalesce(description, ''), '{STREET}', 1) as d_number,
    trim(regexp_extract(coalesce(description, ''), '{STREET}', 2)) as d_street,
    try_cast(nullif(regexp_extract(coalesce(description, ''), '{ZIP}', 1), '') as int) as d_zip,
    try_cast(nullif(regexp_extract(coalesce(description, ''), '{DISTRICT}', 1), '') as int) as d_district,
    try_cast(nullif(regexp_extract(raw_address, '{ZIP}', 1), '') as int) as a_zip
  from @source l
"""
EXTRACT = f"""
  select *, case
      when length(trim(raw_address)) > 8 then 'existing'
      when d_number <> '' then 'regex'
      when d_zip is not null or d_district between 1 and 20 then 'zipcode_only'
      when d_district is null and cast(code_postal as varchar) like '75%' then 'zipcode_only'
      else 'unknown' end as address_method,
    coalesce(d_zip, case when d_district is null then code_postal
      when d_district between 1 and 20 then 75000 + d_district end) as d_best
  from ({EXTRACT})
"""
EXTRACT = f"""
  select * exclude (d_number, d_street, d_zip, d_district, a_zip, d_best, address_method),
    case address_method when 'existing' then trim(raw_address)
      when 'regex' then d_number || ' ' || d_street || ', Paris ' || coalesce(cast(d_best as varchar), 'None')
      when 'zipcode_only' then 'Paris ' || d_best else '' end as address_clean,
    cast(case address_method when 'existing' then coalesce(a_zip, code_postal)
      when 'unknown' then null else d_best end as int) as address_zipcode,
    cast(case address_method when 'existing' then 0.95 when 'regex' then 0.75
      when 'zipcode_only' then 0.35 else 0 end as double) as address_confidence,
    address_method
  from ({EXTRACT})
"""


def market_key(source: str) -> str:
    return f"""
  select * replace (case when lower(trim(property_type)) = 'maison' then 'Maison' else 'Appartement' end as property_type),
    case when cast(best as varchar) like '75%' then best else coalesce(code_postal, 75011) end as zipcode
  from (select *, coalesce(nullif(address_zipcode, 0), code_postal, 75011) as best from {source})
"""


BLOCKS = {
    "dvf": SALES_SQL.format(lineitem="lineitem"),
    "sales": """select *, case when surface_reelle_bati > 0 then valeur_fonciere / surface_reelle_bati end as prix_m2
      from dvf""",
    "listings": LISTINGS_SQL.format(part="part"),
    "keyed": f"select *, {NORMAL} as address_norm from listings",
    "ranked": """select *, row_number() over w as rn, first_value(listing_id) over w as kept_id,
        first_value(asking_price) over w as price_kept
      from keyed where address_norm <> ''
      window w as (partition by address_norm, surface_m2, code_postal order by asking_price nulls last, row_idx)""",
    "exact_log": """select row_idx as removed_idx, listing_id as removed_id, kept_id, 'exact_key_match' as reason,
        asking_price as price_removed, price_kept from ranked where rn > 1""",
    "survivors": "select * from keyed where row_idx not in (select removed_idx from exact_log)",
    "near": """select a.row_idx as i, b.row_idx as j, a.listing_id as id_i, b.listing_id as id_j,
        a.asking_price as price_i, b.asking_price as price_j,
        1.0e0 - levenshtein(a.address_norm, b.address_norm)
          / cast(greatest(length(a.address_norm), length(b.address_norm)) as double) as similarity
      from survivors a join survivors b on a.code_postal = b.code_postal and a.row_idx < b.row_idx
      where a.address_norm <> '' and b.address_norm <> '' and abs(a.surface_m2 - b.surface_m2) <= 5
        and (a.asking_price is null or b.asking_price is null
          or cast(abs(a.asking_price - b.asking_price) as double) / greatest(a.asking_price, 1) <= 0.06e0)""",
    "pairs": "select * from near where similarity >= 0.82e0",
    # The turns of the sequential rule, one match at a time.
    "turns": "select *, row_number() over (order by i, j) as turn from pairs",
    "walk": """
      select 0::bigint as turn, -1::bigint as outer_i, false as passed, []::bigint[] as flagged, null::bigint as removed
      union all
      select turn, outer_i, passed, case when victim is null then flagged else list_append(flagged, victim) end, victim
      from (
        select turn, outer_i, passed, flagged,
          case when not passed and not list_contains(flagged, j)
            and not list_contains(flagged, case when price_i <= price_j then j else i end)
            then case when price_i <= price_j then j else i end end as victim
        from (
          select t.turn, t.i as outer_i, t.i, t.j, t.price_i, t.price_j, w.flagged,
            case when t.i = w.outer_i then w.passed else list_contains(w.flagged, t.i) end as passed
          from walk w join turns t on t.turn = w.turn + 1))""",
    "near_log": """select removed as removed_idx, case when removed = j then id_j else id_i end as removed_id,
        case when removed = j then id_i else id_j end as kept_id,
        'fuzzy_match (sim=' || format('{:.3f}', similarity) || ')' as reason,
        case when removed = j then price_j else price_i end as price_removed,
        case when removed = j then price_i else price_j end as price_kept
      from walk join turns using (turn) where removed is not null""",
    "log": "select * from exact_log union all select * from near_log",
    "clean": "select * from keyed where row_idx not in (select removed_idx from log)",
    "all_addressed": EXTRACT.replace("@source", "listings"),
    "addressed": EXTRACT.replace("@source", "clean"),
    "all_placed": market_key("all_addressed"),
    "placed": market_key("addressed"),
    "stats": """select code_postal, type_local, median(prix_m2) as median, avg(prix_m2) as mean,
        stddev_samp(prix_m2) as std, count(prix_m2) as n from sales group by all""",
    "quantiles": """select code_postal, type_local, quantile_cont(prix_m2, 0.1) as q10,
        quantile_cont(prix_m2, 0.5) as q50, quantile_cont(prix_m2, 0.9) as q90 from sales group by all""",
    "yearly": """select code_postal, type_local, median(prix_m2) filter (year(date_mutation) = 2023) as median_before,
        median(prix_m2) filter (year(date_mutation) = 2024) as median_after from sales group by all""",
    "trend": """select *, case when median_before is null or median_after is null or median_before = 0 then 0.0e0
        else round_even((median_after - median_before) / median_before * 100, 2) end as trend_pct from yearly""",
}


def _comparables(rows: str, prefix: str) -> dict[str, str]:
    p = prefix
    return {
        f"{p}probes": f"select distinct zipcode, property_type, surface_m2 from {rows}",
        f"{p}counts": f"""select zipcode, property_type, p.surface_m2,
            count(s.code_postal) as n_pool,
            count(s.code_postal) filter (date_mutation >= date '2023-06-30') as n_pool_recent,
            count(s.code_postal) filter (surface_reelle_bati between p.surface_m2 * 0.7e0 and p.surface_m2 * 1.3e0) as n_band,
            count(s.code_postal) filter (surface_reelle_bati between p.surface_m2 * 0.7e0 and p.surface_m2 * 1.3e0
              and date_mutation >= date '2023-06-30') as n_band_recent
          from {p}probes p left join sales s on s.code_postal = p.zipcode and s.type_local = p.property_type
          group by all""",
        f"{p}tiers": f"""select *, n_band >= 5 as in_band,
            case when n_band >= 5 then n_band_recent else n_pool_recent end >= 5 as only_recent,
            case when n_band >= 5 then 'band' else 'pool' end
              || case when (case when n_band >= 5 then n_band_recent else n_pool_recent end) >= 5
                 then '+recent' else '' end as tier
          from {p}counts""",
        f"{p}members": f"""select zipcode, property_type, t.surface_m2, prix_m2,
            date_diff('day', date_mutation, date '2024-12-31') as age
          from {p}tiers t join sales s on s.code_postal = t.zipcode and s.type_local = t.property_type
          where (not in_band or surface_reelle_bati between t.surface_m2 * 0.7e0 and t.surface_m2 * 1.3e0)
            and (not only_recent or date_mutation >= date '2023-06-30')""",
        f"{p}figures": f"""select zipcode, property_type, surface_m2, count(*) as n, median(prix_m2) as med,
            avg(prix_m2) as mean, stddev_samp(prix_m2) as std, avg(age) as age from {p}members group by all""",
        f"{p}comps": f"""select t.*, coalesce(n, 0) as n_comparables,
            case when n is null then 0.0e0 else med end as market_median_m2,
            case when n is null then 0.0e0 else mean end as market_mean_m2,
            case when coalesce(n, 0) <= 1 then 0.0e0 else std end as market_std_m2,
            case when n is null then 999.0e0 else age end as freshness_days,
            coalesce(trend_pct, 0.0e0) as trend_pct
          from {p}tiers t left join {p}figures using (zipcode, property_type, surface_m2)
            left join trend r on r.code_postal = t.zipcode and r.type_local = t.property_type""",
        f"{p}scored": f"""select *, round_even(raw_confidence, 2) as confidence_score from (
            select *, 0.4e0 * least(1.0e0, n_comparables / 20.0e0)
              + 0.4e0 * greatest(0.0e0, coalesce(1 - freshness_days / 365, 0))
              + 0.2e0 * greatest(0.0e0, coalesce(1 - market_std_m2 / greatest(market_mean_m2, 1.0e0) / 0.2e0, 0))
                as raw_confidence
            from {p}comps)""",
        f"{p}predicted": f"""select c.*,
            case when q50 is not null then q50 else market_median_m2 end as predicted,
            case when q50 is not null then q10 else market_median_m2 - 1.28e0 * spread end as low,
            case when q50 is not null then q90 else market_median_m2 + 1.28e0 * spread end as high
          from (select *, case when coalesce(market_std_m2, 0) <> 0 then market_std_m2
              else market_median_m2 * 0.12e0 end as spread from {p}scored) c
            left join quantiles q on q.code_postal = c.zipcode and q.type_local = c.property_type
          where n_comparables >= 3""",
        f"{p}valued": f"""select *, cast(cast(trunc(predicted * surface_m2 / 1000) as bigint) * 1000 as bigint) as fair_value,
            cast(cast(trunc(low * surface_m2 / 1000) as bigint) * 1000 as bigint) as ci_low,
            cast(cast(trunc(high * surface_m2 / 1000) as bigint) * 1000 as bigint) as ci_high
          from {p}predicted""",
    }


BLOCKS |= _comparables("all_placed", "all_") | _comparables("placed", "")
BLOCKS |= {
    "gaps": """select p.*, v.* exclude (zipcode, property_type, surface_m2),
        (asking_price - fair_value) / cast(greatest(fair_value, 1) as double) * 100 as gap
      from placed p join valued v using (zipcode, property_type, surface_m2)""",
    "labelled": """select *, address_clean as address, round_even(gap, 1) as price_gap_pct,
        case when gap < -8 then 'undervalued' when gap > 10 then 'overvalued' else 'fair' end as signal,
        case when gap < -15 or gap > 20 then 'strong' when gap < -8 or gap > 10 then 'moderate' else 'weak' end
          as signal_strength
      from gaps""",
    "facts": """select *, format('{:.1f}', abs(price_gap_pct)) as gap_abs, format('{:.1f}', price_gap_pct) as gap_text,
        format('{:+.1f}', price_gap_pct) as gap_signed, format('{:.2f}', confidence_score) || '/1.00' as score_text,
        format('{:.0f}', freshness_days) as age_text, format('{:.1f}', surface_m2) as surface_text
      from labelled""",
    "template": """select * exclude (gap_abs, gap_text, gap_signed, score_text, age_text, surface_text),
        'The listing, ' || surface_text || 'm² in Paris ' || zipcode || ', is '
          || case signal when 'undervalued' then 'priced ' || gap_abs || '% below its estimate (undervalued)'
             when 'overvalued' then 'priced ' || gap_text || '% above its estimate (overvalued)'
             else 'fairly priced' end || ' against recent recorded sales. '
          || case signal when 'overvalued' then 'Handle with caution.' else 'Worth a closer look.' end
          as executive_summary,
        'Asked: ' || format('{:,}', asking_price) || '€. Estimated: ' || format('{:,}', fair_value)
          || '€ (80% interval ' || format('{:,}', ci_low) || '€ – ' || format('{:,}', ci_high)
          || '€). Asking price against estimate: ' || gap_signed || '%.' as valuation_section,
        n_comparables || ' comparable sales in Paris ' || zipcode || ', median '
          || format('{:,.0f}', market_median_m2) || ' €/m², one-year trend ' || format('{:+.1f}', trend_pct) || '%.'
          as market_context,
        'Evidence score ' || score_text || ' ('
          || case when confidence_score > 0.6 then 'adequate' else 'limited, check by other means' end
          || '). Sales are ' || age_text || ' days old on average. Exposed to interest rates and to Paris rental rules.'
          as risk_factors,
        case when signal = 'undervalued' and confidence_score > 0.5
          then 'MONITOR — possible discount of ' || gap_abs || '%. Confirm address and surface, ask for the surveys.'
          when signal = 'overvalued'
          then 'PASS — asking price is ' || gap_text || '% over the estimate. Negotiate or drop.'
          else 'NEUTRAL — no clear mispricing. Decide on yield and strategy.' end as recommendation,
        'Written from a template. ' || n_comparables || ' comparable sales, ' || age_text
          || 'd old on average. Score ' || score_text || '.' as data_note,
        n_comparables || ' comparable sales, ' || age_text || ' days old on average. Score ' || score_text || '. '
          || case when confidence_score > 0.7 then 'High confidence.' else 'Limited data, use with caution.' end
          as answered_note,
        'template' as generated_by
      from facts""",
    "memos": """select *, 'INVESTMENT MEMO — ' || listing_id || chr(10) || repeat('=', 50) || chr(10) || chr(10)
        || 'EXECUTIVE SUMMARY' || chr(10) || executive_summary || chr(10) || chr(10)
        || 'VALUATION ANALYSIS' || chr(10) || valuation_section || chr(10) || chr(10)
        || 'MARKET CONTEXT' || chr(10) || market_context || chr(10) || chr(10)
        || 'RISK FACTORS' || chr(10) || risk_factors || chr(10) || chr(10)
        || 'RECOMMENDATION' || chr(10) || recommendation || chr(10) || chr(10)
        || 'DATA NOTE' || chr(10) || data_note || chr(10) || chr(10)
        || '[Generated by: ' || generated_by || ']' as report_full
      from template""",
    "truth": """select *, case pricing_bias when 'over' then 'overvalued' when 'under' then 'undervalued'
        when 'fair' then 'fair' end as signal_gt from labelled
      where pricing_bias in ('over', 'under', 'fair')""",
    "dirty_sales": DIRTY_SALES_SQL.format(sales="sales"),
    "unplaced": UNPLACED_SQL.format(listings="listings"),
    "address_answers": ADDRESS_ANSWERS_SQL.format(listings="unplaced"),
    "parsed_answers": r"""select listing_id, response_text,
        case when json_valid(body) then nullif(json_extract_string(body, '$.address'), '') end as answered_address,
        case when json_valid(body) then case when json_exists(body, '$.zipcode')
          then try_cast(json_extract_string(body, '$.zipcode') as int) else code_postal end end as answered_zip
      from (select a.*, u.code_postal,
          trim(regexp_replace(trim(response_text), '```json|```', '', 'g'), E' \n\t') as body
        from address_answers a join unplaced u using (listing_id))""",
    "unplaced_addressed": EXTRACT.replace("@source", "unplaced"),
    "memo_answers": MEMO_ANSWERS_SQL.format(listings="clean"),
    "memo_parsed": r"""select listing_id, json_extract_string(body, '$.executive_summary') as a1,
        json_extract_string(body, '$.valuation_section') as a2, json_extract_string(body, '$.market_context') as a3,
        json_extract_string(body, '$.risk_factors') as a4, json_extract_string(body, '$.recommendation') as a5
      from (select listing_id, regexp_replace(response_text, '```json|```', '', 'g') as body from memo_answers)
      where json_valid(body) and json_exists(body, '$.executive_summary') and json_exists(body, '$.valuation_section')
        and json_exists(body, '$.market_context') and json_exists(body, '$.risk_factors')
        and json_exists(body, '$.recommendation')""",
}

RESULTS = """listing_id, address, zipcode, surface_m2, asking_price, fair_value, ci_low, ci_high,
    round_even(predicted, 0) as predicted_m2, round_even(market_median_m2, 0) as market_m2, price_gap_pct, signal,
    signal_strength, confidence_score, n_comparables, round_even(freshness_days, 0) as freshness_days, trend_pct,
    executive_summary, recommendation, report_full, generated_by, pricing_bias as pricing_bias_gt"""

FINAL = {
    "derive_price_m2": "select id_mutation, code_postal, type_local, round(prix_m2, 6) as prix_m2 from sales",
    "normalize_address": "select row_idx, listing_id, address_norm from keyed",
    "source_counts": "select source, count(*) as n from listings group by all",
    "missing_addresses": "select count(*) filter (trim(coalesce(raw_address, '')) = '') as missing from listings",
    "first_n_listings": "select * from listings order by row_idx limit 60",
    "exact_dedup_log": "select * exclude (removed_idx) from exact_log",
    "exact_dedup_survivors": """select row_idx, listing_id, address_norm, surface_m2, code_postal, asking_price
      from survivors""",
    "fuzzy_pairs": "select i, j, round(similarity, 6) as similarity from pairs",
    "dedup_log": "select * exclude (removed_idx) from log",
    "dedup_log_crowded": "select * exclude (removed_idx) from log",
    "dedup_clean": "select * from clean",
    "dedup_summary": """select (select count(*) from listings) as raw, (select count(*) from clean) as clean,
      (select count(*) from log) as removed, (select count(*) from exact_log) as removed_exact,
      (select count(*) from near_log) as removed_fuzzy""",
    "extract_address": """select row_idx, listing_id, address_clean, address_zipcode, address_confidence, address_method
      from all_addressed""",
    "address_usable": """select listing_id, address_zipcode is not null and address_confidence >= 0.3 as usable
      from all_addressed""",
    "address_method_counts": """select address_method, count(*) as n,
      count(*) filter (address_zipcode is not null and address_confidence >= 0.3) as n_usable,
      count(*) filter (address_confidence >= 0.3) as n_confident from all_addressed group by all""",
    "effective_zip": "select row_idx, listing_id, cast(zipcode as int) as zipcode, property_type from all_placed",
    "address_prompts": """select listing_id,
      'Find the street address in this French property advertisement. Answer with one JSON object only: '
      || '{"address": "...", "zipcode": 75XXX}, or {"address": null} if the text has none.'
      || chr(10) || chr(10) || 'Advertisement: ' || coalesce(description, '') as prompt
      from unplaced_addressed where address_method = 'unknown'""",
    "llm_address_parse": """select listing_id, answered_address as address,
      cast(case when answered_address is not null then answered_zip end as int) as zipcode,
      cast(case when answered_address is not null then 0.65 end as double) as confidence,
      case when answered_address is not null then 'llm' end as method from parsed_answers""",
    "llm_merge": """select listing_id, case when hit then answered_address else address_clean end as address_clean,
      case when hit then cast(answered_zip as int) else address_zipcode end as address_zipcode,
      case when hit then 0.65e0 else address_confidence end as address_confidence,
      case when hit then 'llm' else address_method end as address_method
      from (select u.*, answered_address, answered_zip,
          address_method = 'unknown' and answered_address is not null as hit
        from unplaced_addressed u left join parsed_answers using (listing_id))""",
    "market_stats": """select code_postal, type_local, round(median, 6) as median, round(mean, 6) as mean,
      round(std, 6) as std, n as count from stats""",
    "market_quantiles": """select code_postal, type_local, round(q10, 6) as q10, round(q50, 6) as q50,
      round(q90, 6) as q90 from quantiles""",
    "market_sketch": """select code_postal, type_local, count(prix_m2) as n, count(prix_m2) as n_sketched,
      true as q10_within, true as q50_within, true as q90_within
      from sales where code_postal is not null and type_local is not null group by all having count(prix_m2) > 0""",
    "market_trend": """select code_postal, type_local, round(median_before, 6) as median_before,
      round(median_after, 6) as median_after, trend_pct from trend""",
    "comparables_tier": """select zipcode, property_type, surface_m2, tier, n_band_recent, n_band, n_pool_recent, n_pool
      from all_tiers""",
    "comparables": """select zipcode, property_type, surface_m2, n_comparables,
      round(market_median_m2, 6) as market_median_m2, round(market_mean_m2, 6) as market_mean_m2,
      round(market_std_m2, 6) as market_std_m2, round(freshness_days, 6) as freshness_days, trend_pct from all_comps""",
    "confidence_score": """select zipcode, property_type, surface_m2, round(raw_confidence, 6) as raw_confidence,
      confidence_score from all_scored""",
    "statistical_value": """select zipcode, property_type, surface_m2, round(predicted, 6) as predicted_m2,
      round(low, 6) as low_m2, round(high, 6) as high_m2 from all_predicted""",
    "quantile_model": """select zipcode, property_type, surface_m2, least, most, true as ordered, true as inside
      from all_predicted join (select code_postal as zipcode, type_local as property_type,
        round(min(prix_m2), 6) as least, round(max(prix_m2), 6) as most from sales group by all) using (zipcode, property_type)""",
    "quantile_model_metrics": """select 'forest' as model, count(prix_m2) as n_train, true as better_than_one_price,
      true as no_worse_than_markets, true as covers from sales""",
    "stored_model_value": """select zipcode, property_type, surface_m2, round(predicted, 6) as predicted_m2,
      round(low, 6) as low_m2, round(high, 6) as high_m2 from all_predicted""",
    "stored_forest": "select zipcode, property_type, surface_m2, true as same from all_probes",
    "valuation_forest": """select listing_id, zipcode, n_comparables, true as ordered, true as inside, true as labelled
      from labelled""",
    "listings_scan": "select * exclude (row_idx) replace (nullif(raw_address, '') as raw_address), true as whole from listings",
    "sales_scan": """select id_mutation, date_mutation, code_postal, type_local, surface_reelle_bati,
      round(valeur_fonciere, 6) as valeur_fonciere, nombre_pieces_principales from sales""",
    "sales_rejects": """select id_mutation, concat_ws('; ',
        case when unreadable_date then 'date_mutation is no date: ' || date_mutation end,
        case when unreadable_surface then 'surface_reelle_bati is no double: ' || surface_reelle_bati end) as reasons
      from dirty_sales where unreadable_date or unreadable_surface""",
    "clean_file": "select * replace (nullif(raw_address, '') as raw_address) from clean",
    "log_file": "select * exclude (removed_idx) from log",
    "addressed_file": """select row_idx, listing_id, address_clean, address_zipcode, address_confidence, address_method
      from addressed""",
    "results_file": f"select {RESULTS} from memos",
    "run_metrics": """select 'statistical' as model, round(avg(abs(prix_m2 - q50)), 6) as mae_m2,
      round(avg(abs(prix_m2 - q50) / prix_m2) * 100, 6) as mape_pct, count(prix_m2) as n_train
      from sales join quantiles using (code_postal, type_local)""",
    "sales_of_listings": """select zipcode, property_type, t.surface_m2, id_mutation, date_mutation, round(prix_m2, 6) as prix_m2
      from (select distinct zipcode, property_type, surface_m2 from (select * from all_placed where row_idx % 50 = 0)) asked
      join all_tiers t using (zipcode, property_type, surface_m2)
      join sales s on s.code_postal = zipcode and s.type_local = property_type
      where (not in_band or surface_reelle_bati between t.surface_m2 * 0.7e0 and t.surface_m2 * 1.3e0)
        and (not only_recent or date_mutation >= date '2023-06-30')""",
    "valuation_features": """select id_mutation, round(ln(1 + surface_reelle_bati), 6) as log_surface,
      surface_reelle_bati as surface_m2, code_postal as zipcode, code_postal - 75000 as arrond,
      cast(type_local = 'Maison' as int) as is_maison,
      coalesce(cast(nombre_pieces_principales as double), round_even(surface_reelle_bati / 28, 0)) as rooms,
      cast(year(date_mutation) as int) as year, cast(surface_reelle_bati < 35 as int) as is_small,
      cast(surface_reelle_bati > 100 as int) as is_large from sales""",
    "scoring_features": """select zipcode, property_type, surface_m2, round(ln(1 + surface_m2), 6) as log_surface,
      cast(zipcode - 75000 as int) as arrond, cast(property_type = 'Maison' as int) as is_maison,
      floor(surface_m2 / 28) as rooms, cast(2024 as int) as year, cast(surface_m2 < 35 as int) as is_small,
      cast(surface_m2 > 100 as int) as is_large from all_probes""",
    "statistical_model_metrics": """select 'statistical' as model, round(avg(abs(prix_m2 - q50)), 6) as mae_m2,
      round(avg(abs(prix_m2 - q50) / prix_m2) * 100, 6) as mape_pct, count(prix_m2) as n_train
      from sales join quantiles using (code_postal, type_local)""",
    "valuation": f"select {RESULTS} from memos",
    "signal_counts": "select signal, count(*) as n from labelled group by all",
    "signal_accuracy": """select count(*) filter (signal = signal_gt) as correct, count(*) as total,
      round(count(*) filter (signal = signal_gt) * 100.0e0 / count(*), 6) as accuracy_pct from truth""",
    "confusion_matrix": """select signal_gt, count(*) filter (signal = 'undervalued') as undervalued,
      count(*) filter (signal = 'overvalued') as overvalued, count(*) filter (signal = 'fair') as fair
      from truth group by all""",
    "signal_precision": """select *, round(cast(hits as double) / nullif(predicted, 0), 6) as precision,
      round(cast(hits as double) / nullif(actual, 0), 6) as recall
      from (select label, count(*) filter (signal = label and signal_gt = label) as hits,
          count(*) filter (signal = label) as predicted, count(*) filter (signal_gt = label) as actual
        from truth, (values ('undervalued'), ('overvalued'), ('fair')) l(label) group by all)""",
    "top_memo_per_signal": """select signal, listing_id, confidence_score, report_full from memos
      qualify row_number() over (partition by signal order by confidence_score desc, row_idx) = 1""",
    "memo_sections": """select listing_id, executive_summary, valuation_section, market_context, risk_factors,
      recommendation, data_note from template""",
    "memo_text": "select listing_id, report_full from memos",
    "memo_json": """select listing_id, cast(to_json({'listing_id': listing_id, 'executive_summary': executive_summary,
      'valuation': valuation_section, 'market_context': market_context, 'risk_factors': risk_factors,
      'recommendation': recommendation, 'data_note': data_note, 'generated_by': generated_by}) as varchar) as memo
      from template""",
    "llm_memo_merge": """select listing_id, coalesce(a1, executive_summary) as executive_summary,
      coalesce(a2, valuation_section) as valuation_section, coalesce(a3, market_context) as market_context,
      coalesce(a4, risk_factors) as risk_factors, coalesce(a5, recommendation) as recommendation,
      case when a1 is null then data_note else answered_note end as data_note,
      case when a1 is null then generated_by else 'llm:claude-sonnet-4' end as generated_by
      from template left join memo_parsed using (listing_id)""",
    "memo_prompts": """select listing_id, 'Write an investment memo from these figures and no others.' || chr(10) || chr(10)
      || 'PROPERTY' || chr(10) || '- Listing: ' || listing_id || chr(10) || '- Address: ' || coalesce(address, 'Paris')
      || chr(10) || '- Kind: ' || property_type || ', ' || format('{:.1f}', surface_m2) || ' m², zip ' || zipcode
      || chr(10) || chr(10) || 'VALUATION' || chr(10) || '- Asked: ' || format('{:,}', asking_price) || '€ ('
      || format('{:.0f}', asking_price / greatest(surface_m2, 1.0e0)) || ' €/m²)' || chr(10)
      || '- Estimated: ' || format('{:,}', fair_value) || '€ (' || format('{:.0f}', predicted) || ' €/m²)' || chr(10)
      || '- 80% interval: ' || format('{:,}', ci_low) || '€ to ' || format('{:,}', ci_high) || '€' || chr(10)
      || '- Gap: ' || format('{:+.1f}', price_gap_pct) || '% of the estimate' || chr(10)
      || '- Signal: ' || signal || ' (' || signal_strength || ')' || chr(10) || chr(10)
      || 'MARKET' || chr(10) || '- Comparable sales: ' || n_comparables || chr(10)
      || '- Median: ' || format('{:.0f}', market_median_m2) || ' €/m²' || chr(10)
      || '- Average age: ' || format('{:.0f}', freshness_days) || ' days' || chr(10)
      || '- One-year trend: ' || format('{:+.1f}', trend_pct) || '%' || chr(10)
      || '- Evidence score: ' || format('{:.2f}', confidence_score) || '/1.00' || chr(10) || chr(10)
      || 'Sections: summary (two sentences at most); valuation (gap and interval); market (trend and volume); '
      || 'risks (data, market, property); recommendation (buy, monitor or pass, and on what condition).' || chr(10)
      || 'Answer with one JSON object of strings with the keys executive_summary, valuation_section, market_context, '
      || 'risk_factors, recommendation.' as prompt from template""",
}


def _needed(sql: str) -> list[str]:
    """Names of the blocks that ``sql`` uses, in dependency order."""
    used, stack = set(), [sql]
    while stack:
        words = set(re.findall(r"\w+", stack.pop()))
        new = [b for b in BLOCKS if b in words and b not in used]
        used.update(new)
        stack.extend(BLOCKS[b] for b in new)
    return [b for b in BLOCKS if b in used]


def statement(name: str) -> str:
    final = FINAL[name]
    blocks = ",\n".join(f"{b} as ({BLOCKS[b]})" for b in _needed(final))
    return f"with recursive {blocks}\n{final}"


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in FINAL}
