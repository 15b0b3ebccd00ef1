"""The same answers in SQL, written independently of the library, for DuckDB."""

from __future__ import annotations


def r(expr: str, digits: int) -> str:
    return f"cast(round(try_cast({expr} as decimal(38,10)), {digits}) as double)"


def ctes(*names: str) -> str:
    """``with`` clause with the named views and those they build on, in definition order."""
    needed: set[str] = set()

    def need(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for other in _USES[name]:
                need(other)

    for name in names:
        need(name)
    return "with " + ",\n".join(f"{n} as ({_VIEWS[n]})" for n in _VIEWS if n in needed) + "\n"


def _ema(x: str, span: int, where: str = "") -> str:
    a = f"(2.0::double/{span + 1})"
    return (f"list_reduce(list({x}) {where} over (partition by ticker order by date "
            f"rows between unbounded preceding and current row), lambda e, v: e*(1-{a}) + v*{a})")


def _frame(n: int) -> str:
    return f"(partition by ticker order by date rows between {n - 1} preceding and current row)"


def _full(n: int, value: str, expr: str) -> str:
    return f"case when count({value}) over {_frame(n)} = {n} then {expr} end"


_INDICATORS = ("daily_return_pct, sma_7, sma_30, ema_12, ema_26, macd, macd_signal, macd_histogram, "
               "rsi_14, bb_middle, bb_upper, bb_lower, volatility_7d, volume_zscore")

_VIEWS = {
    "ticks": """
        select event_type as ticker, value as price,
               cast(json_extract_string(props, '$.k') as bigint) as volume,
               epoch_us(ts) // 1000 as timestamp_ms, event_id as seq,
               make_timestamp(epoch_us(ts) // 1000 * 1000) as event_time
        from events""",
    "dirty_rules": """
        select *, case when seq % 97 = 0 then 'null_price' when seq % 89 = 0 then 'negative_price'
               when seq % 83 = 0 then 'nan_price' when seq % 79 = 0 then 'empty_ticker'
               when seq % 73 = 0 then 'null_ticker' when seq % 71 = 0 then 'negative_volume'
               when seq % 67 = 0 then 'zero_time' else 'none' end as rule
        from ticks""",
    "dirty_ticks": """
        select case rule when 'empty_ticker' then '' when 'null_ticker' then null else ticker end as ticker,
               case rule when 'null_price' then null when 'negative_price' then -price
                    when 'nan_price' then 'nan'::double else price end as price,
               case rule when 'negative_volume' then -1 else volume end as volume,
               case rule when 'zero_time' then 0 else timestamp_ms end as timestamp_ms, seq
        from dirty_rules""",
    "checked_ticks": """
        select *, coalesce(ticker <> '' and price > 0 and not isnan(price) and volume >= 0
                           and timestamp_ms > 0, false) as valid
        from dirty_ticks""",
    "minute_bars": f"""
        select ticker, date_trunc('minute', event_time) as window_start,
               date_trunc('minute', event_time) + interval 1 minute as window_end,
               first(price order by timestamp_ms, seq) as open, max(price) as high, min(price) as low,
               last(price order by timestamp_ms, seq) as close,
               cast(sum(volume) as bigint) as volume,
               {r('''case when sum(volume) > 0
                    then sum(cast(price * volume as decimal(30,8)))::double / sum(volume)
                    else sum(cast(price as decimal(30,8)))::double / count(*) end''', 4)} as vwap,
               count(*) as trade_count
        from ticks where price > 0 and volume >= 0 group by 1, 2, 3""",
    "daily": """
        select ticker, date_trunc('day', event_time)::timestamp as date,
               first(price order by seq) as open, max(price) as high, min(price) as low,
               last(price order by seq) as close, cast(sum(volume) as bigint) as volume
        from ticks group by 1, 2""",
    "daily_li": """
        select upper(p_brand) as ticker, date_trunc('day', l_shipdate)::timestamp as date,
               first(price order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as open,
               max(price) as high, min(price) as low,
               last(price order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as close,
               cast(sum(l_quantity) as bigint) as volume
        from (select *, l_extendedprice / l_quantity as price from lineitem join part on l_partkey = p_partkey)
        group by 1, 2""",
    "daily_dirty": """
        select case when day(date) = 21 then '' else ticker end as ticker, date,
               case day(date) when 3 then null when 5 then 0.0 else open end as open,
               case when day(date) = 9 then low - 1 else high end as high, low, close,
               case day(date) when 13 then -1 when 17 then null else volume end as volume
        from daily_li""",
    "duplicated": """
        select *, 'batch-0' as batch_id from daily_li
        union all
        select ticker, date, open, high, low, close + 1, volume, 'batch-1' from daily_li where day(date) % 3 = 0""",
    "moves": """
        select *, lag(close) over (partition by ticker order by date) as prev from daily_li""",
    "layer1": f"""
        select *,
               case when prev <> 0 then close / prev - 1 end as ret,
               greatest(close - prev, 0) as gain, greatest(prev - close, 0) as loss,
               {_full(7, 'close', r(f'avg(close) over {_frame(7)}', 4))} as sma_7,
               {_full(30, 'close', r(f'avg(close) over {_frame(30)}', 4))} as sma_30,
               {r(_ema('close', 12), 4)} as ema_12,
               {r(_ema('close', 26), 4)} as ema_26,
               {_full(20, 'close', r(f'avg(close) over {_frame(20)}', 4))} as bb_middle,
               {_full(20, 'close', f'2 * stddev_samp(close) over {_frame(20)}')} as spread,
               {_full(20, 'volume', r(f'(volume - avg(volume) over {_frame(20)}) / nullif(stddev_samp(volume) over {_frame(20)}, 0)', 4))} as volume_zscore,
               avg(close) over earlier as mean20, stddev_samp(close) over earlier as dev20
        from moves
        window earlier as (partition by ticker order by date rows between 20 preceding and 1 preceding)""",
    "layer2": f"""
        select *,
               {r('ret * 100', 4)} as daily_return_pct,
               {r('ema_12 - ema_26', 4)} as macd,
               {r('bb_middle + spread', 4)} as bb_upper, {r('bb_middle - spread', 4)} as bb_lower,
               {_full(7, 'ret', r(f'stddev_samp(ret) over {_frame(7)}', 6))} as volatility_7d,
               {_ema('gain', 14, 'filter (prev is not null)')} as avg_gain,
               {_ema('loss', 14, 'filter (prev is not null)')} as avg_loss,
               coalesce(dev20 > 0 and abs(close - mean20) > 3 * dev20, false) as is_outlier
        from layer1""",
    "layer3": f"""
        select *, {r(_ema('macd', 9), 4)} as macd_signal,
               {r('100 - 100 / (1 + avg_gain / nullif(avg_loss, 0))', 4)} as rsi_14
        from layer2""",
    "silver": f"""
        select *, {r('macd - macd_signal', 4)} as macd_histogram from layer3""",
    "dim_ticker": """
        select cast(row_number() over (order by symbol) as integer) as ticker_id, symbol,
               symbol || ' Corp.' as company_name, 'Unknown' as sector, 'Unknown' as exchange
        from (select distinct ticker as symbol from daily_li)""",
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as integer) as date_id, d as date,
               dayofweek(d) + 1 as day_of_week, isodow(d) as iso_dow, dayname(d) as day_name,
               weekofyear(d) as week, isoyear(d) as iso_year, month(d) as month, monthname(d) as month_name,
               quarter(d) as quarter, year(d) as year,
               d in (select date from daily_li) as is_trading_day
        from (select unnest(generate_series(min(date), max(date), interval 1 day)) as d
              from daily_li)""",
    "sessions": """
        select * from (values
            (1, 'pre_market', '04:00', '09:30', 'Pre-market trading session (ET)'),
            (2, 'regular', '09:30', '16:00', 'Regular trading session (ET)'),
            (3, 'after_hours', '16:00', '20:00', 'After-hours trading session (ET)'))
            t(session_id, session_type, open_time, close_time, description)""",
    # the events lie in winter: Eastern time is five hours behind UTC
    "session_ticks": """
        select seq, ticker, session_id, session_type
        from ticks left join sessions
          on strftime(event_time - interval 5 hour, '%H:%M') >= open_time
         and strftime(event_time - interval 5 hour, '%H:%M') < close_time""",
    "fact": f"""
        select ticker_id, cast(strftime(date, '%Y%m%d') as integer) as date_id, ticker, date,
               open, high, low, close, volume, null::double as vwap, {_INDICATORS}, is_outlier,
               lead(close) over (partition by ticker order by date) as target_next_close, prev
        from silver join dim_ticker on ticker = symbol""",
    "wide": """
        select ticker, ticker_id, date_id, date, target_next_close as actual, close as current_close,
               close as naive, sma_7 as sma, close + (close - prev) as momentum
        from fact where target_next_close is not null""",
    "long": """
        select ticker_id, date_id, actual, current_close, 'naive' as model, naive as predicted from wide
        union all select ticker_id, date_id, actual, current_close, 'sma', sma from wide where sma is not null
        union all select ticker_id, date_id, actual, current_close, 'momentum', momentum from wide
                  where momentum is not null""",
    "predictions": f"""
        select ticker, date::timestamp + interval 16 hour as predicted_at,
               {r('momentum', 2)} as predicted_close,
               case when momentum > current_close then 'UP' else 'DOWN' end as predicted_direction,
               'momentum' as model_used, actual
        from wide where momentum is not null""",
    "loaded": """
        select * exclude (prev) from fact
        where target_next_close is not null and rsi_14 is not null and sma_30 is not null
          and daily_return_pct is not null and volatility_7d is not null and volume_zscore is not null
          and bb_upper is not null""",
    "split": """
        select *, case when rn <= floor(n * 0.70::double) then 'train'
                       when rn <= floor(n * (0.70::double + 0.15::double)) then 'validation'
                       else 'test' end as split
        from (select *, row_number() over (partition by ticker_id order by date_id) as rn,
                     count(*) over (partition by ticker_id) as n from loaded)""",
    "metrics": f"""
        select model, {r('avg(abs(actual - predicted))', 6)} as mae,
               {r('sqrt(avg((actual - predicted) * (actual - predicted)))', 6)} as rmse,
               {r('100 * avg(case when actual <> 0 then abs((actual - predicted) / actual) end)', 6)} as mape_pct,
               {r('100.0 * count(*) filter (sign(actual - current_close) = sign(predicted - current_close)) / count(*)', 6)} as dir_accuracy_pct,
               {r('''coalesce(avg(sign(predicted - current_close) * (actual - current_close) / current_close)
                    / nullif(stddev_pop(sign(predicted - current_close) * (actual - current_close) / current_close), 0)
                    * sqrt(252), 0)''', 6)} as sharpe,
               count(*) as n_scored
        from scored group by model""",
    "residuals": """
        select model, avg(actual - predicted) as mean_residual, stddev_pop(actual - predicted) as std_residual,
               min(actual - predicted) as low, max(actual - predicted) as high
        from long group by model""",
}

_USES = {
    "ticks": [], "dirty_rules": ["ticks"], "dirty_ticks": ["dirty_rules"], "checked_ticks": ["dirty_ticks"],
    "minute_bars": ["ticks"], "daily": ["ticks"], "daily_li": [], "daily_dirty": ["daily_li"],
    "duplicated": ["daily_li"], "moves": ["daily_li"], "layer1": ["moves"], "layer2": ["layer1"],
    "layer3": ["layer2"], "silver": ["layer3"], "dim_ticker": ["daily_li"], "dim_date": ["daily_li"],
    "sessions": [], "session_ticks": ["ticks", "sessions"], "fact": ["silver", "dim_ticker"],
    "wide": ["fact"], "long": ["wide"], "predictions": ["wide"], "loaded": ["fact"], "split": ["loaded"],
    "scored": [], "metrics": ["scored"], "residuals": ["long"],
}

_BAR = "ticker, window_start, window_end, open, high, low, close, volume, vwap, trade_count"
_FEATURES = ["open", "high", "low", "close", "volume", "sma_7", "sma_30", "ema_12", "ema_26", "rsi_14",
             "macd", "macd_signal", "macd_histogram", "bb_upper", "bb_middle", "bb_lower",
             "daily_return_pct", "volatility_7d", "volume_zscore"]
_ISO = ("strftime(event_time, '%Y-%m-%dT%H:%M:%S') || case when epoch_ms(event_time) % 1000 = 0 then '' "
        "else '.' || lpad(cast(epoch_ms(event_time) % 1000 as varchar), 3, '0') || '000' end || '+00:00'")
# a window is final once the newest event is five minutes past its end
_CLOSED = "window_end <= (select max(event_time) from ticks where price > 0 and volume >= 0) - interval 5 minute"
_FEED_TRADE = """'{"s":' || coalesce('"' || ticker || '"', 'null') || ',"p":'
    || case when price is null or isnan(price) then 'null' else cast(price as varchar) end
    || ',"v":' || volume || ',"t":' || timestamp_ms || ',"c":[' || ((volume % 5 + 5) % 5) || ']}'"""


def _scored(sql_source: str) -> str:
    """Metrics over one set of forecasts."""
    return ctes("long") + f", scored as ({sql_source}), metrics as ({_VIEWS['metrics']})\n"


def _indicator(columns: str) -> str:
    return ctes("silver") + f"select ticker, date, {columns} from silver"


_FACT_COLUMNS = ("ticker_id, date_id, open, high, low, close, volume, vwap, " + _INDICATORS
                 + ", is_outlier, target_next_close")

ORACLE = {
    # sources and sinks
    "parse_ticks": ctes("ticks") + f"""
        select ticker as kafka_key, ticker, price, volume, timestamp_ms, {_ISO} as timestamp,
               cast(volume % 5 as integer) as condition, 'events' as source, seq, event_time from ticks""",
    "unwrap_feed": ctes("ticks") + f"""
        select seq // 4 as line,
               cast(row_number() over (partition by seq // 4 order by seq) - 1 as integer) as element,
               ticker, price, volume, timestamp_ms, {_ISO} as timestamp,
               cast(volume % 5 as integer) as condition, 'feed_ws' as source
        from ticks qualify price > 0""",
    "publish_payload": ctes("ticks") + """
        select ticker as key, ticker, cast(timestamp_ms as varchar) as timestamp_ms,
               cast(volume as varchar) as volume, 'events' as source, price from ticks""",
    "dead_letter": ctes("checked_ticks") + f"""
        select {_FEED_TRADE} as original_message, 'validation_failed' as error_reason, ticker
        from checked_ticks where not valid
        union all
        select '{{bad', 'invalid_json', null from ticks where seq % 101 = 0""",
    "feed_counts": ctes("checked_ticks") + """
        select (select count(distinct seq // 4) + count(*) filter (seq % 50 = 0) + count(*) filter (seq % 101 = 0)
                from ticks) as messages,
               (select count(*) from ticks where seq % 101 = 0) as invalid_json,
               count(*) filter (valid) as published, count(*) filter (not valid) as rejected
        from checked_ticks""",
    "csv_roundtrip": ctes("daily") + """
        select ticker, date::timestamp as date, open, high, low, close, volume, 'events' as source,
               '2024-02-01 00:00:00' as ingested_at from daily
        union all
        select ticker, date::timestamp, open, high, low, close, volume, 'events', '2024-02-01 00:00:00' from daily""",
    "json_roundtrip": ctes("ticks") + "select ticker, price, volume, timestamp_ms, seq from ticks",
    "bronze_roundtrip": ctes("daily") + """
        select ticker, date::timestamp as window_start, date::timestamp + interval 1 day as window_end,
               open, high, low, close, volume, null::double as vwap, null::bigint as trade_count,
               '1d' as bar_interval, 'history' as source_api, 'batch-0' as batch_id, date from daily""",
    "silver_roundtrip": ctes("daily") + f"""
        select ticker, date, close, volume,
               coalesce(stddev_samp(close) over earlier > 0
                        and abs(close - avg(close) over earlier) > 3 * stddev_samp(close) over earlier, false) as is_outlier,
               {_full(7, 'close', r(f'avg(close) over {_frame(7)}', 4))} as sma_7,
               {_full(20, 'close', r(f'avg(close) over {_frame(20)}', 4))} as bb_middle,
               {r('(close / nullif(lag(close) over (partition by ticker order by date), 0) - 1) * 100', 4)} as daily_return_pct
        from daily
        window earlier as (partition by ticker order by date rows between 20 preceding and 1 preceding)""",
    "partition_pruned_scan": ctes("daily") + "select upper(ticker) as ticker, date, close, volume from daily where ticker = 'click'",
    "preview_n": ctes("ticks") + """
        select cast(seq % 3 as integer) as partition, seq as "offset", ticker as key,
               cast(timestamp_ms as varchar) as value from ticks order by 1, 2 limit 100""",
    # projections and checks
    "validate_ticks": ctes("checked_ticks") + """
        select ticker, price, volume, timestamp_ms, seq from checked_ticks where valid""",
    "invalid_ticks": ctes("checked_ticks") + """
        select ticker, case when not isnan(price) then price end as price,
               coalesce(isnan(price), false) as price_is_nan, volume, timestamp_ms, seq
        from checked_ticks where not valid""",
    "ingest_counts": ctes("checked_ticks") + """
        select count(*) as total_rows, count(*) filter (valid) as valid_rows,
               count(*) filter (not valid) as rejected_rows from checked_ticks""",
    "validate_daily": ctes("daily_dirty") + """
        select ticker, date::timestamp as date, open, high, low, close, volume,
               coalesce(ticker <> '' and open > 0 and high > 0 and low > 0 and close > 0 and high >= low
                        and volume >= 0 and date is not null, false) as valid
        from daily_dirty""",
    "align_daily": ctes("daily_li") + """
        select ticker, date::timestamp as window_start, date::timestamp + interval 1 day as window_end,
               open, high, low, close, volume, null::double as vwap, null::bigint as trade_count from daily_li""",
    "normalise_history": ctes("daily_li") + f"""
        select ticker, timezone('UTC', timezone('America/New_York', date::timestamp)) as date,
               {r('open', 4)} as open, {r('high', 4)} as high, {r('low', 4)} as low, {r('close', 4)} as close,
               volume, 'history' as source from daily_li""",
    "bronze_meta": ctes("daily_li") + """
        select ticker, date::timestamp as window_start, date::timestamp + interval 1 day as window_end, close,
               volume, '1d' as bar_interval, 'history' as source_api, 'batch-0' as batch_id, date,
               true as stamped from daily_li""",
    "date_parts": ctes("dim_date") + """
        select * exclude (is_trading_day), date as back from dim_date where is_trading_day""",
    # bars
    "bars_1min": ctes("minute_bars") + f"select {_BAR} from minute_bars",
    "bars_daily": ctes("ticks") + """
        select ticker, date_trunc('day', event_time)::timestamp as window_start,
               date_trunc('day', event_time)::timestamp + interval 1 day as window_end,
               first(price order by timestamp_ms, seq) as open, max(price) as high, min(price) as low,
               last(price order by timestamp_ms, seq) as close, cast(sum(volume) as bigint) as volume,
               count(*) as trade_count
        from ticks where price > 0 group by 1, 2, 3""",
    "vwap": ctes("ticks") + f"""
        select ticker, date_trunc('day', event_time)::timestamp as window_start, cast(sum(volume) as bigint) as volume,
               {r('sum(cast(price * volume as decimal(30,8)))::double / sum(volume)', 4)} as vwap,
               count(*) as trade_count
        from ticks where price > 0 group by 1, 2""",
    "lambda_union": ctes("minute_bars", "daily") + f"""
        select {_BAR}, '1m' as bar_interval, 'feed_ws' as source_api, 'stream-0' as batch_id,
               date_trunc('day', window_start)::timestamp as date from minute_bars
        union all
        select ticker, date::timestamp, date::timestamp + interval 1 day, open, high, low, close, volume,
               null, null, '1d', 'history', 'batch-0', date from daily""",
    "candles": ctes("minute_bars") + f"""
        select ticker, window_start, open, high, low, close, close >= open as is_up,
               least(open, close) as body_bottom, {r('abs(close - open)', 4)} as body_height from minute_bars""",
    # cleaning and indicators
    "dedup_latest": ctes("duplicated") + """
        select ticker, date::timestamp as window_start, close, volume, batch_id from duplicated
        qualify row_number() over (partition by ticker, date order by batch_id desc) = 1""",
    "silver_clean": ctes("duplicated") + """
        select ticker, date::timestamp as window_start, close, volume, batch_id
        from duplicated where day(date) not in (7, 11)
        qualify row_number() over (partition by ticker, date order by batch_id desc) = 1""",
    "outlier_flag": _indicator("close, is_outlier"),
    "ind_return": _indicator("daily_return_pct"),
    "ind_sma": _indicator("sma_7, sma_30"),
    "ind_ema": _indicator("ema_12, ema_26"),
    "ind_macd": _indicator("macd, macd_signal, macd_histogram"),
    "ind_rsi": _indicator("rsi_14"),
    "ind_bollinger": _indicator("bb_middle, bb_upper, bb_lower"),
    "ind_volatility": _indicator("volatility_7d"),
    "ind_volume_z": _indicator("volume_zscore"),
    "indicators_all": _indicator("close, volume, is_outlier, " + _INDICATORS),
    "indicators_small_blocks": _indicator("close, volume, is_outlier, " + _INDICATORS),
    "indicators_in_batches": _indicator("close, volume, is_outlier, " + _INDICATORS),
    "quality_report": ctes("silver") + """,
        numbered as (select *, row_number() over (partition by ticker order by date) as rn from silver),
        counts as (select count(*) as total_rows,
            count(*) filter (close is null) as c1, count(*) filter (ticker is null) as c2,
            count(*) filter (close <= 0) as c3, count(*) filter (high < low) as c4,
            count(*) filter (volume < 0) as c5, count(*) filter (sma_7 is null and rn >= 7) as c6,
            count(*) filter (rsi_14 < 0 or rsi_14 > 100) as c7, count(*) filter (is_outlier) as c8 from numbered),
        rules as (
            select 'no_null_close' as rule, 'CRITICAL' as severity, c1 as violations, total_rows from counts
            union all select 'no_null_ticker', 'CRITICAL', c2, total_rows from counts
            union all select 'close_positive', 'CRITICAL', c3, total_rows from counts
            union all select 'high_gte_low', 'WARNING', c4, total_rows from counts
            union all select 'volume_non_negative', 'WARNING', c5, total_rows from counts
            union all select 'sma_7_not_null_after_day_7', 'INFO', c6, total_rows from counts
            union all select 'rsi_in_range', 'WARNING', c7, total_rows from counts
            union all select 'outlier_pct_below_5', 'WARNING', c8, total_rows from counts)
        select rule, severity, violations, total_rows,
               case when rule = 'outlier_pct_below_5' then violations * 100.0 / total_rows < 5
                    else violations = 0 end as pass from rules""",
    "quality_verdict": ctes("silver") + """,
        numbered as (select *, row_number() over (partition by ticker order by date) as rn from silver),
        fails as (select
            (case when count(*) filter (close is null) > 0 then 1 else 0 end)
            + (case when count(*) filter (ticker is null) > 0 then 1 else 0 end)
            + (case when count(*) filter (close <= 0) > 0 then 1 else 0 end) as critical,
            (case when count(*) filter (high < low) > 0 then 1 else 0 end)
            + (case when count(*) filter (volume < 0) > 0 then 1 else 0 end)
            + (case when count(*) filter (sma_7 is null and rn >= 7) > 0 then 1 else 0 end)
            + (case when count(*) filter (rsi_14 < 0 or rsi_14 > 100) > 0 then 1 else 0 end)
            + (case when count(*) filter (is_outlier) * 100.0 / count(*) >= 5 then 1 else 0 end) as others
            from numbered)
        select case when critical > 0 then 'critical_failed' when others > 0 then 'warnings' else 'all_passed' end as verdict,
               cast(critical + others as bigint) as failed_rules, cast(8 as bigint) as rules from fails""",
    # star schema
    "dim_ticker": ctes("dim_ticker") + "select * from dim_ticker",
    "dim_ticker_grow": ctes("dim_ticker") + """
        select cast(row_number() over (
                   order by cast(split_part(symbol, '#', 2) as integer) <= 20, symbol) as integer) as ticker_id,
               symbol, company_name, sector, exchange from dim_ticker""",
    "dim_date": ctes("dim_date") + "select * from dim_date",
    "dim_market_session": ctes("session_ticks") + """
        select s.*, n as ticks from sessions s
        left join (select session_id, count(*) as n from session_ticks group by 1) t on s.session_id = t.session_id""",
    "session_join": ctes("session_ticks") + "select seq, ticker, session_id, session_type from session_ticks",
    "fact_prices": ctes("fact") + f"select {_FACT_COLUMNS} from fact",
    "star_join": ctes("fact") + """
        select ticker as symbol, date, close, volume, sma_7, rsi_14, target_next_close from fact""",
    "load_counts": ctes("dim_ticker", "dim_date", "sessions") + """
        select 'dim_ticker' as tbl, count(*) as rows from dim_ticker
        union all select 'dim_date', count(*) from dim_date
        union all select 'dim_market_session', count(*) from sessions
        union all select 'fact_stock_prices', count(*) from daily_li""",
    "table_counts": ctes("dim_date", "minute_bars", "predictions") + """
        select 'fact_stock_prices' as tbl, count(*) as rows from daily_li
        union all select 'dim_date', count(*) from dim_date
        union all select 'stock_prices_stream', count(*) from minute_bars
        union all select 'predictions', count(*) from predictions""",
    # serving
    "history": ctes("fact") + f"""
        select date_id, {r('open', 2)} as open, {r('high', 2)} as high, {r('low', 2)} as low,
               {r('close', 2)} as close, volume, {r('sma_7', 2)} as sma_7, {r('sma_30', 2)} as sma_30,
               {r('rsi_14', 2)} as rsi_14
        from (select * from fact where ticker = 'BRAND#11' order by date_id desc limit 30)""",
    "latest_close": ctes("fact") + """
        select ticker_id, max(date_id) as date_id, arg_max(close, date_id) as close from fact group by 1""",
    "live_monitor": ctes("minute_bars") + """
        select ticker, window_start, close, volume from minute_bars order by window_start desc, ticker limit 10""",
    "bi_close_sma": ctes("fact") + "select ticker as symbol, date, close, sma_7, sma_30 from fact",
    "bi_volume": ctes("fact") + "select ticker as symbol, date, volume from fact",
    "bi_rsi": ctes("fact") + """
        select ticker as symbol, date, rsi_14, 70 as overbought, 30 as oversold from fact""",
    "bi_prediction_history": ctes("predictions") + """
        select ticker, date_trunc('day', predicted_at)::timestamp as date, predicted_close, actual as actual_close,
               predicted_direction from predictions""",
    "bi_weekly_accuracy": ctes("predictions") + f"""
        select date_trunc('week', predicted_at)::timestamp as week,
               {r('''100.0 * sum(case when (predicted_direction = 'UP' and actual > predicted_close)
                     or (predicted_direction = 'DOWN' and actual < predicted_close) then 1 else 0 end)
                     / count(*)''', 1)} as accuracy_pct
        from predictions where actual is not null group by 1""",
    "bi_live_60min": ctes("minute_bars") + """
        select window_start, open, high, low, close, volume from minute_bars
        where ticker = 'click' and window_start >= (select max(window_start) from minute_bars) - interval 60 minute""",
    "bi_vwap_sma10": ctes("minute_bars") + f"""
        select ticker, window_start, close, vwap,
               {r('avg(close) over (partition by ticker order by window_start rows between 9 preceding and current row)', 4)} as sma_10
        from minute_bars
        where cast(window_start as date) = (select cast(max(window_start) as date) from minute_bars)""",
    "sma10_partial": ctes("minute_bars") + f"""
        select ticker, window_start, close,
               {r('avg(close) over (partition by ticker order by window_start rows between 9 preceding and current row)', 4)} as sma_10
        from minute_bars""",
    "prediction_log": ctes("predictions") + """
        select ticker, predicted_at, predicted_close, predicted_direction, model_used,
               null::double as actual_close from predictions""",
    "prediction_actuals": ctes("predictions") + """
        select ticker, predicted_at, predicted_close, predicted_direction, model_used,
               actual as actual_close from predictions""",
    "upsert_merge": ctes("duplicated") + """
        select ticker, date::timestamp as window_start, close, volume, batch_id from duplicated
        qualify row_number() over (partition by ticker, date order by batch_id desc) = 1""",
    "upsert_merged_on_read": ctes("duplicated") + """
        select ticker, date::timestamp as window_start, close, volume, batch_id from duplicated
        qualify row_number() over (partition by ticker, date order by batch_id desc) = 1""",
    "upsert_do_nothing": ctes("daily_li") + """
        select ticker, date::timestamp as window_start from daily_li""",
    "upsert_insert_only": ctes("duplicated") + """
        select ticker, date::timestamp as window_start, close, batch_id from duplicated
        where batch_id = 'batch-0' or day(date) % 2 <> 0
        qualify row_number() over (partition by ticker, date order by batch_id desc) = 1""",
    # streaming
    "stream_bars_append": ctes("minute_bars") + f"select {_BAR} from minute_bars where {_CLOSED}",
    "stream_late_drop": ctes("minute_bars") + f"select {_BAR} from minute_bars where {_CLOSED}",
    "stream_restart": ctes("minute_bars") + f"select {_BAR} from minute_bars where {_CLOSED}",
    "stream_upsert": ctes("minute_bars") + f"select {_BAR}, 'feed_ws' as source_api from minute_bars",
    "stream_merge_on_read": ctes("minute_bars") + f"select {_BAR}, 'feed_ws' as source_api from minute_bars",
    "stream_dual_sink": ctes("minute_bars") + f"""
        select 'bronze' as sink, ticker, window_start, close, volume from minute_bars where {_CLOSED}
        union all select 'upsert', ticker, window_start, close, volume from minute_bars""",
    "stream_dead_letter": ctes("checked_ticks") + """
        select ticker, 'validation_failed' as error_reason, timestamp_ms, volume from checked_ticks where not valid""",
    # model preparation, forecasts, scores
    "ml_load": ctes("loaded") + f"select ticker_id, date_id, {', '.join(_FEATURES)}, target_next_close from loaded",
    "ml_load_counts": ctes("loaded") + """
        select (select count(*) from fact) as total_rows,
               (select count(*) from fact where target_next_close is null) as null_target,
               (select count(*) from fact where target_next_close is not null) - (select count(*) from loaded) as null_features,
               (select count(*) from loaded) as kept_rows""",
    "expanding_sums": ctes("fact") + f""",
        d as (select ticker_id, date_id, close - lag(close) over (partition by ticker_id order by date_id) as d1 from fact),
        l as (select *, lag(d1) over w as d2, lag(d1, 2) over w as d3 from d window w as (partition by ticker_id order by date_id))
        select ticker_id, date_id, count(d3) over w as n, {", ".join(r(f"coalesce(sum(case when d3 is not null then {a} * {b} end) over w, 0) / 1000000", 2) + f" as {n}"
            for n, a, b in (("g11", "d2", "d2"), ("g12", "d2", "d3"), ("g22", "d3", "d3"), ("m1", "d2", "d1"), ("m2", "d3", "d1")))}
        from l window w as (partition by ticker_id order by date_id)""",
    "time_split": ctes("split") + "select ticker_id, date_id, split from split",
    "scale_features": ctes("split") + f""",
        stats as (select ticker_id, {', '.join(f'avg({c}) as m_{c}, stddev_pop({c}) as s_{c}' for c in _FEATURES)}
                  from split where split = 'train' group by 1)
        select ticker_id, date_id, split,
               {', '.join(f"{r(f'({c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end', 6)} as {c}" for c in _FEATURES)}
        from split join stats using (ticker_id)""",
    "lookback_sequences": ctes("split") + f"""
        select ticker_id, date_id, target_next_close, 30 as steps, 19 as features,
               lag(close, 30) over w as first_close, lag(close, 1) over w as last_close,
               cast(lag(volume, 30) over w as double) as first_volume,
               lag(volume_zscore, 1) over w as last_volume_zscore,
               {', '.join(f"{r(f'avg({c}) over (partition by ticker_id order by date_id rows between 30 preceding and 1 preceding)', 6)} as mean_{c}" for c in _FEATURES)}
        from split window w as (partition by ticker_id order by date_id) qualify rn > 30""",
    "naive_forecast": ctes("split") + """
        select ticker_id, date_id, 'naive' as model, target_next_close as actual, close as predicted,
               close as current_close from split where split = 'test'""",
    "forecast_overlay": ctes("long") + f"""
        select ticker_id, date_id, actual, current_close, model, {r('predicted', 6)} as predicted from long""",
    "forecast_metrics": _scored("select * from long") + "select * from metrics",
    "metrics_common_rows": _scored("select * from long where sma_known") + "select * from metrics",
    "model_comparison": _scored("select * from long") + """
        select model, mae as "MAE", rmse as "RMSE", mape_pct as "MAPE (%)",
               dir_accuracy_pct as "Dir. Accuracy (%)", sharpe as "Sharpe Ratio" from metrics""",
    "best_model": _scored("select * from long") + """
        select arg_min(model, mae) as best, min(mae) as best_mae, arg_min(model, rmse) as best_rmse_model,
               arg_min(model, mape_pct) as best_mape_model,
               (select model from metrics order by dir_accuracy_pct desc, model limit 1) as best_dir_accuracy_model,
               (select model from metrics order by sharpe desc, model limit 1) as best_sharpe_model from metrics""",
    "residual_stats": ctes("residuals") + f"""
        select model, {', '.join(f"{r(c, 6)} as {c}" for c in ('mean_residual', 'std_residual', 'low', 'high'))}
        from residuals""",
    "residual_hist": ctes("residuals") + """
        select l.model, cast(case when high > low
                 then least(floor((actual - predicted - low) / ((high - low) / 30)), 29) else 15 end as integer) as bin,
               count(*) as frequency
        from long l join residuals r on l.model = r.model group by 1, 2""",
}
ORACLE["metrics_common_rows"] = _scored(
    "select l.* from long l join wide w using (ticker_id, date_id) "
    "where w.sma is not null and w.momentum is not null") + "select * from metrics"

ORACLE["tick_previous_close"] = ctes("ticks", "daily") + """
    select t.seq, t.ticker, t.price, d.close as previous_close
    from ticks t asof left join daily d
      on t.ticker = d.ticker and t.event_time >= cast(d.date as timestamp) + interval 1 day"""
ORACLE["history_rejects"] = ctes("daily_li") + """
    select case day(date) when 3 then 'close' when 5 then 'close,volume' when 7 then 'volume' when 11 then 'date' else 'none' end as failed,
           count(*) as rows
    from daily_li group by 1"""
