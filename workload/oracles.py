"""The same results in plain SQL: windows, joins, and a bar-by-bar recursion for trades."""

from __future__ import annotations


def _candles(name: str, interval: str) -> str:
    return f"""{name} as (
  select symbol, time_bucket(interval '{interval}', ts) as bar_ts,
         min_by(price, row(ts, event_id)) as open, max(price) as high, min(price) as low,
         max_by(price, row(ts, event_id)) as close, cast(sum(qty) as double) as volume
  from w group by symbol, time_bucket(interval '{interval}', ts))"""


WALK = """w as (
  select event_type as symbol, ts, event_id, cast(value as decimal(18,2)) as qty,
         cast(500 + 0.01 * sum(cast(value as decimal(18,2)) - 50) over (
           partition by event_type order by ts, event_id
           rows between unbounded preceding and current row) as double) as price
  from events)"""

CANDLES = f"{WALK}, {_candles('candles', '1 hour')}"
CANDLES_15 = f"{WALK}, {_candles('candles', '15 minutes')}"

BARS = f"""{CANDLES}, bars as materialized (
  select *, row_number() over (partition by symbol order by bar_ts) - 1 as idx from candles)"""


def _mean(column: str, bars: int) -> str:
    frame = f"(partition by symbol order by idx rows between {bars - 1} preceding and current row)"
    return f"case when count({column}) over {frame} = {bars} then avg({column}) over {frame} end"


def _beats(column: str, sign: str) -> str:
    others = [f"lag({column}, {n}) over s" for n in (1, 2)]
    others += [f"lead({column}, {n}) over s" for n in (1, 2)]
    return " and ".join(f"{column} {sign} {o}" for o in others)


INDICATORS = f"""{BARS}, i1 as (
  select *,
    (open - lag(open, 4) over s) / lag(open, 4) over s * 100 as pc,
    {_mean('volume', 20)} as volume_ma,
    list(volume) over (partition by symbol order by idx rows between 49 preceding and current row) as seen,
    {_mean('close', 10)} as sma_trend,
    {_mean('close', 50)} as sma50,
    case when lag(close) over s is not null then
      greatest(high - low, abs(high - lag(close) over s), abs(low - lag(close) over s)) end as tr,
    (close - lag(close, 10) over s) / lag(close, 10) over s * 100 as roc,
    case when {_beats('high', '>')} then 1 else 0 end as swing_high,
    case when {_beats('low', '<')} then 1 else 0 end as swing_low
  from bars window s as (partition by symbol order by idx)),
i2 as (select *, {_mean('tr', 14)} as atr from i1),
ind as materialized (select *, {_mean('atr', 20)} as avg_atr,
    case when len(seen) = 50 then
      (len(list_filter(seen, lambda z: z < volume)) + (len(list_filter(seen, lambda z: z = volume)) + 1) / 2.0)
      / 50 * 100 end as volume_percentile
  from i2)"""

ABOVE = "({0}) - ({1}) > 1e-12 * greatest(abs({0}), abs({1}))"

CROSSINGS = f"""{INDICATORS}, c0 as (
  select *, lag(pc) over (partition by symbol order by idx) as prev_pc from ind),
c1 as (
  select *, case when prev_pc > -0.005 and pc <= -0.005 then 'bear'
                 when prev_pc < 0.005 and pc >= 0.005 then 'bull' end as side from c0),
c2 as (
  select *, coalesce(volume_percentile >= 30, false) as volume_ok,
    case when sma_trend is null or sma50 is null or roc is null then true
         when side = 'bull' then {ABOVE.format('sma_trend', 'sma50')}
         else {ABOVE.format('sma50', 'sma_trend')} end as trend_ok,
    coalesce(not ({ABOVE.format('atr', 'avg_atr * 2')}), true) as volatility_ok
  from c1 where side is not null),
c3 as (
  select *, volume_ok and (sma_trend is null or sma50 is null or roc is null
                           or (trend_ok and volatility_ok)) as accepted from c2),
crossings as materialized (
  select c3.symbol, c3.idx, c3.side, any_value(c3.pc) as pc, any_value(c3.prev_pc) as prev_pc,
    any_value(volume_ok) as volume_ok, any_value(trend_ok) as trend_ok,
    any_value(volatility_ok) as volatility_ok, any_value(accepted) as accepted,
    max(b.idx) as start_idx, max_by(b.high, b.idx) as top, max_by(b.low, b.idx) as bot
  from c3 left join bars b
    on b.symbol = c3.symbol and b.idx between c3.idx - 15 and c3.idx - 4
    and case when c3.side = 'bear' then b.close > b.open else b.close < b.open end
  group by c3.symbol, c3.idx, c3.side)"""

CANDIDATES = f"""{CROSSINGS}, candidates as materialized (
  select symbol, side, idx as trigger_idx, start_idx, top, bot,
    row_number() over (partition by symbol order by idx) as rn
  from crossings where accepted and start_idx is not null)"""

ZONES = f"""{CANDIDATES}, thin as (
  select symbol, rn, trigger_idx, trigger_idx as last_kept, true as kept
  from candidates where rn = 1
  union all
  select c.symbol, c.rn, c.trigger_idx,
    case when c.trigger_idx - t.last_kept >= 5 then c.trigger_idx else t.last_kept end,
    c.trigger_idx - t.last_kept >= 5
  from thin t join candidates c on c.symbol = t.symbol and c.rn = t.rn + 1),
zones as materialized (
  select c.symbol, c.side, c.trigger_idx, c.start_idx, c.top, c.bot
  from candidates c join thin t on c.symbol = t.symbol and c.rn = t.rn where t.kept)"""


def _signals(entry_at: str) -> str:
    column = {"origin": "start_idx", "trigger": "trigger_idx"}[entry_at]
    return f"""signals as (
  select symbol, {column} as idx, side, count(*) as n_copies from zones
  group by symbol, {column}, side)"""


def _walk_bars(entry_at: str, decimals: int | None) -> str:
    """One step per bar: trail and stop, then the signals of the bar, then the state after."""
    size = "cash / close"
    if decimals is not None:
        size = f"round_even(cash / close, {decimals})"
    return f"""{ZONES}, {_signals(entry_at)},
tape as materialized (
  select b.symbol, b.idx, b.bar_ts, b.close, coalesce(case s.side when 'bull' then 1 else -1 end, 0) as sig,
    coalesce(s.n_copies, 0) as copies
  from bars b left join (select * from signals where idx >= 1) s
    on s.symbol = b.symbol and s.idx = b.idx),
tape2 as materialized (
  select symbol, idx, bar_ts, close, case when copies = 0 then 0 else sig end as sig, copies from tape),
steps as (
  select symbol, idx, bar_ts, close, 0 as pos, 0.0::double as stop, 0.0::double as size, 0.0::double as entry_price,
    -1::bigint as entry_idx, 100.0::double as capital, 100.0::double as entry_capital,
    0 as out_pos, 0.0::double as out_stop, 0.0::double as out_size, 0.0::double as out_entry,
    -1::bigint as out_idx, 0.0::double as out_capital, '' as out_reason, 0.0::double as stop_now
  from tape2 where idx = 0
  union all
  select symbol, idx, bar_ts, close,
    case when opens then sig when ends then 0 else pos end,
    case when opens then close * (case when sig = 1 then 1 - 0.02 else 1 + 0.02 end) else trail end,
    case when opens then {size} else size end,
    case when opens then close else entry_price end,
    case when opens then idx else entry_idx end,
    cash,
    case when opens then cash else entry_capital end,
    case when ends then pos else 0 end, trail, size, entry_price, entry_idx, entry_capital,
    case when stopped then 'stop' when ends then 'opposite' else '' end,
    case when pos <> 0 then trail end
  from (
    select *, capital + case when ends then pos * (size * close - size * entry_price) else 0 end as cash,
      sig <> 0 and (pos = 0 or stopped or (ends and copies >= 2)) as opens
    from (
      select *, stopped or (pos <> 0 and sig = -pos) as ends
      from (
        select *, (pos = 1 and close <= trail) or (pos = -1 and close >= trail) as stopped
        from (
          select t.symbol, t.idx, t.bar_ts, t.close, t.sig, t.copies, p.pos, p.size, p.entry_price,
            p.entry_idx, p.capital, p.entry_capital,
            case p.pos when 1 then greatest(p.stop, t.close * (1 - 0.015))
                       when -1 then least(p.stop, t.close * (1 + 0.015)) else p.stop end as trail
          from steps p join tape2 t on t.symbol = p.symbol and t.idx = p.idx + 1))))),
tail as (select symbol, max(idx) as last_idx from bars group by symbol),
closed as (
  select symbol, out_pos as pos, out_idx as entry_idx, out_entry as entry_price, out_capital as entry_capital,
    out_size as size, out_stop as stop, idx as exit_idx, close as exit_price, bar_ts as exit_time, out_reason as kind
  from steps where out_pos <> 0
  union all
  select s.symbol, pos, entry_idx, entry_price, entry_capital, size, stop, idx, close, bar_ts, 'end'
  from steps s join tail on tail.symbol = s.symbol and tail.last_idx = s.idx where pos <> 0),
numbered as (
  select c.*, row_number() over (partition by c.symbol order by c.entry_idx) as trade_no,
    b.bar_ts as entry_time, pos * (size * exit_price - size * entry_price) as pnl
  from closed c join bars b on b.symbol = c.symbol and b.idx = c.entry_idx)"""


# Half-even rounding of the position size; exact halves do not occur in these quotients.
def _even(sql: str) -> str:
    return sql.replace("round_even(", "round(")


def _trades(entry_at: str = "origin", decimals: int | None = None, stop: str = "stop",
            reason: str = "stop_loss") -> str:
    first = "entry_price * (case when pos = 1 then 1 - 0.02 else 1 + 0.02 end)"
    return _even(f"""{_walk_bars(entry_at, decimals)},
trades as (
  select symbol, trade_no, case when pos = 1 then 'long' else 'short' end as type, entry_idx, exit_idx,
    entry_price, entry_time, entry_capital, size as position_size,
    {'stop' if stop == 'stop' else first} as stop_loss, exit_price, exit_time, pnl,
    entry_capital + pnl as exit_capital,
    case kind when 'stop' then '{reason}' when 'opposite' then 'opposite_signal' else 'end_of_data' end as exit_reason,
    pnl / entry_capital * 100 as return_pct
  from numbered)""")


TRADES = _trades()
ROUNDED = _trades(decimals=8, stop="first", reason="trailing_stop")
TRIGGER = _trades(entry_at="trigger")

_TRADE_SELECT = """
select symbol, trade_no, type, entry_idx, exit_idx, round(entry_price, 6) as entry_price, entry_time,
  round(entry_capital, 6) as entry_capital, round(position_size, 6) as position_size,
  round(stop_loss, 8) as stop_loss, round(exit_price, 6) as exit_price, exit_time, round(pnl, 6) as pnl,
  round(exit_capital, 6) as exit_capital, exit_reason, round(return_pct, 6) as return_pct
from trades"""

_SHOWN = f", shown as ({_TRADE_SELECT})"

_EQUITY_SELECT = """
select symbol, idx, bar_ts, pos as position,
  round(capital + case when pos <> 0 then pos * (size * close - size * entry_price) else 0 end, 6) as equity
from steps"""


def _q(ctes: str, select: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes}\n{select}"


def _ind(*columns: str) -> str:
    flags = ("swing_high", "swing_low")
    shown = ", ".join(c if c in flags else f"round({c}, 8) as {c}" for c in columns)
    return _q(INDICATORS, f"select symbol, idx, {shown} from ind")


CANDLE_SELECT = "select symbol, bar_ts, open, high, low, close, volume from candles"

_STATS = """count(*) as n_trades,
  round(avg(case when pnl > 0 then 1.0 else 0.0 end) * 100, 5) as win_rate,
  round(coalesce(avg(case when pnl > 0 then pnl end), 0), 5) as avg_win,
  round(coalesce(avg(case when pnl < 0 then pnl end), 0), 5) as avg_loss,
  round(avg(return_pct), 5) as avg_return_pct, round(max(pnl), 5) as max_pnl,
  round(min(pnl), 5) as min_pnl, round(avg(entry_capital), 5) as avg_entry_capital,
  round(case when coalesce(avg(case when pnl < 0 then pnl end), 0) = 0 then 'inf'::double
    else abs(coalesce(avg(case when pnl > 0 then pnl end), 0) / avg(case when pnl < 0 then pnl end)) end, 5)
    as profit_factor"""
_SYMBOL_STATS = f"""symbol, {_STATS}, round(max_by(exit_capital, trade_no), 5) as final_capital,
  round(max_by(exit_capital, trade_no) - 100, 5) as total_return_pct"""

RANGES = """ranges as (
  select symbol, date_trunc('day', min(bar_ts)) as start_ts, date_trunc('day', max(bar_ts)) + interval '1 day' as end_ts
  from candles group by symbol)"""

LINES = """lines as (
  select l_orderkey, l_linenumber, l_suppkey, l_partkey as product_id, l_quantity as size,
    case when l_returnflag = 'R' then 'sell' else 'buy' end as side,
    case when l_linestatus = 'O' then 'limit_order' else 'market_order' end as order_type,
    l_extendedprice as price, l_discount as discount, l_tax as tax from lineitem)"""

INTENTS = f"""{LINES}, intents as (
  select l_orderkey, l_linenumber, product_id, cast(trunc(size) as bigint) as size, side, order_type,
    case when order_type = 'limit_order' then price end as limit_price,
    case when discount < 0.02 then 'ioc' when discount > 0.08 then 'day' end as time_in_force,
    'false' as post_only, case when side = 'sell' then 'true' else 'false' end as reduce_only,
    case when discount > 0.08 then 'rejected' else 'ok' end as status
  from lines where abs(size) >= 1e-8)"""

def _tick(name: str, tick: str, places: int) -> str:
    """Tick rounding on whole ten-thousandths, so that nothing is rounded on the way."""
    price = "cast(cast(p_retailprice as decimal(18,4)) * 10000 as bigint)"
    step = f"cast(cast({tick} as decimal(18,4)) * 10000 as bigint)"
    rest, down = f"({price} % {step})", f"({price} // {step} * {step})"
    low_rest = f"((((-{price}) % {step}) + {step}) % {step})"
    low_down = f"(-{price} - {low_rest})"

    def shown(value: str, kind: str) -> str:
        return f"round(({value}) / 10000.0, {places})::double as {name}_{kind}"

    return ",\n  ".join(
        [
            shown(f"case when {rest} * 2 >= {step} then {down} + {step} else {down} end", "nearest"),
            shown(down, "floor"),
            shown(f"case when {rest} = 0 then {down} else {down} + {step} end", "ceil"),
            shown(f"{down} + {step}", "ceil_up"),
            shown(
                f"case when {low_rest} * 2 >= {step} then {low_down} + {step} else {low_down} end",
                "below_zero",
            ),
        ]
    )


def _resampled(interval: str) -> str:
    return _q(
        CANDLES_15,
        f"""select symbol, time_bucket(interval '{interval}', bar_ts) as bar_ts, min_by(open, bar_ts) as open,
  max(high) as high, min(low) as low, max_by(close, bar_ts) as close, round(sum(volume), 4) as volume
from candles group by symbol, time_bucket(interval '{interval}', bar_ts)""",
    )


def _gate(column: str) -> str:
    return _q(CROSSINGS, f"select symbol, idx, side, {column} from crossings")


_TRADED = {
    "trades": _q(TRADES, _TRADE_SELECT, True),
    "trades_rounded": _q(ROUNDED, _TRADE_SELECT, True),
    "trades_at_trigger": _q(TRIGGER, _TRADE_SELECT, True),
    "equity": _q(TRADES, _EQUITY_SELECT, True),
    "equity_rounded": _q(ROUNDED, _EQUITY_SELECT, True),
    "equity_at_trigger": _q(TRIGGER, _EQUITY_SELECT, True),
}


def _part(*names: str) -> str:
    return _q(TRADES + _SHOWN, f"select symbol, trade_no, {', '.join(names)} from shown", True)


ORACLES: dict[str, str] = {
    "stream_candles": """
select event_type as symbol, time_bucket(interval '1 hour', ts) as bar_ts,
  min_by(value, row(ts, event_id)) as open, max(value) as high, min(value) as low,
  max_by(value, row(ts, event_id)) as close, round(sum(value), 4) as volume
from events group by event_type, time_bucket(interval '1 hour', ts)
having time_bucket(interval '1 hour', ts) + interval '1 hour'
  <= (select date_trunc('millisecond', max(ts)) - interval '10 minutes' from events)""",
    "stream_dedupe": _q(CANDLES, CANDLE_SELECT),
    "stream_signals": _q(ZONES, "select symbol, side, trigger_idx, start_idx, top, bot from zones", True),
    "stream_signals_corrected": _q(ZONES, "select symbol, side, trigger_idx, start_idx, top, bot from zones", True),
    "stream_positions": _q(
        TRIGGER,
        """select symbol, trade_no, type, entry_idx, exit_idx, round(entry_price, 6) as entry_price, entry_time,
  round(entry_capital, 6) as entry_capital, round(position_size, 6) as position_size,
  round(stop_loss, 8) as stop_loss, round(exit_price, 6) as exit_price, round(pnl, 6) as pnl,
  round(exit_capital, 6) as exit_capital, exit_reason
from trades where exit_reason <> 'end_of_data'""",
        True,
    ),
    "stream_equity": _TRADED["equity_at_trigger"],
    # Without the bars after a gap that the watermark has not passed at the end.
    "stream_gaps": _q(
        f"""{BARS}, mark as (select date_trunc('millisecond', max(bar_ts)) - interval '1 day' as mark_ts from bars
  where idx % 97 <> 50),
stuck as (
  select g.symbol, min(g.idx) as idx from bars g left join bars n on n.symbol = g.symbol and n.idx = g.idx + 1
  where g.idx % 97 = 50 and (n.idx is null or n.bar_ts > (select mark_ts from mark)) group by g.symbol)""",
        """select symbol, b.idx, case when b.idx % 97 = 51 then 1 else 0 end::bigint as n_missing
from bars b left join stuck s using (symbol) where b.idx % 97 <> 50 and (s.idx is null or b.idx < s.idx)""",
    ),
    "candle_scan": _q(
        CANDLES,
        f"{CANDLE_SELECT} where symbol = 'view' and bar_ts between timestamp '2024-01-09 23:00:00' "
        "and timestamp '2024-01-20 00:00:00'",
    ),
    "candle_envelope": _q(
        CANDLES,
        "select symbol, bar_ts, open, high, low, close, case when hour(bar_ts) <> 5 then volume end as volume "
        "from candles where symbol <> 'error'",
    ),
    "candle_envelope_errors": _q(
        CANDLES,
        "select symbol, 'unavailable' as error, count(distinct date_trunc('day', bar_ts)) as n "
        "from candles where symbol = 'error' group by symbol",
    ),
    "candle_normalize": _q(
        CANDLES,
        "select symbol, bar_ts, open, high, low, case when close < open then null else close end as close, "
        "case when hour(bar_ts) <> 7 then volume end as volume from candles",
    ),
    "candle_times": _q(
        CANDLES, f"{CANDLE_SELECT} where hour(bar_ts) not in (3, 9, 15, 21)"
    ),
    "candle_time_rejects": _q(
        CANDLES,
        """select symbol,
  case hour(bar_ts) when 3 then epoch(bar_ts)::bigint || '.5' when 9 then strftime(bar_ts, '%Y-%m-%d %H:%M')
    when 21 then epoch(bar_ts)::bigint || '000' end as raw_time,
  case hour(bar_ts) when 3 then 'fractional' when 9 then 'not a number' when 15 then 'missing'
    else 'out of range' end as reason, open, high, low, close, volume
from candles where hour(bar_ts) in (3, 9, 15, 21)""",
    ),
    "intake_counts": _q(
        CANDLES,
        """select count(*) as rows_in, count(*) filter (good and symbol <> 'error') as kept,
  count(*) filter (good and symbol = 'error') as no_symbol, count(*) filter (not good) as bad_time,
  count(*) filter (good and symbol <> 'error' and volume > 50) as bad_numbers
from (select *, hour(bar_ts) not in (3, 9, 15, 21) as good from candles)""",
    ),
    "backfill_union": _q(CANDLES, CANDLE_SELECT),
    "backfill_plan": _q(
        f"{CANDLES}, {RANGES}",
        """select symbol, (row_number() over (partition by symbol order by began) - 1)::bigint as slice,
  began::timestamp as start_ts, least(began + interval '100 hours', end_ts)::timestamp as end_ts
from (select symbol, end_ts, unnest(generate_series(start_ts, end_ts - interval '1 second', interval '100 hours')) as began
  from ranges)""",
    ),
    "backfill_coverage": _q(
        CANDLES,
        """select symbol, min(bar_ts) as start_ts, max(bar_ts) as end_ts, count(*) as n_bars
from (select symbol, bar_ts,
  bar_ts - to_hours(row_number() over (partition by symbol order by bar_ts)) as run from candles)
group by symbol, run""",
    ),
    "backfill_gaps": _q(
        f"""{CANDLES}, {RANGES}, hours as (
  select symbol, unnest(generate_series(start_ts, end_ts - interval '1 second', interval '1 hour')) as bar_ts from ranges),
lacking as (select symbol, bar_ts from hours anti join candles using (symbol, bar_ts))""",
        """select symbol, min(bar_ts)::timestamp as start_ts, (max(bar_ts) + interval '1 hour')::timestamp as end_ts,
  count(*) as n_missing
from (select symbol, bar_ts,
  bar_ts - to_hours(row_number() over (partition by symbol order by bar_ts)) as run from lacking)
group by symbol, run""",
    ),
    "latest_window": _q(
        CANDLES,
        "select symbol, bar_ts, open, high, low, close, volume from (select *, max(bar_ts) over "
        "(partition by symbol) as newest from candles) where bar_ts >= newest - interval '50 hours'",
    ),
    "latest_bars": _q(
        CANDLES,
        "select symbol, bar_ts, open, high, low, close, volume from candles "
        "qualify row_number() over (partition by symbol order by bar_ts desc) <= 50",
    ),
    "lookback_days": _q(
        CANDLES,
        f"{CANDLE_SELECT} where bar_ts between timestamp '2024-01-13 12:00:00' and timestamp '2024-01-20 12:00:00'",
    ),
    "candle_csv": _q(CANDLES, f"{CANDLE_SELECT} where hour(bar_ts) <> 0"),
    "candle_csv_rejects": _q(
        CANDLES, "select symbol, open, high, low, close, volume from candles where hour(bar_ts) = 0"
    ),
    "resample_1h": _resampled("1 hour"),
    "resample_4h": _resampled("4 hours"),
    "resample_1d": _resampled("1 day"),
    "candles_from_ticks": _q(CANDLES, CANDLE_SELECT),
    "candles_from_ticks_15m": _q(CANDLES_15, CANDLE_SELECT),
    "history_page": (
        "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders "
        "where o_orderkey > 100 and o_orderstatus = 'F' order by o_orderkey limit 100"
    ),
    "fills_page": (
        "select o_orderkey, o_orderpriority, o_totalprice from orders "
        "where o_orderkey > 250 and o_orderpriority in ('1-URGENT', '2-HIGH') order by o_orderkey limit 100"
    ),
    "history_cursor": (
        "select count(*) as n_rows, case when count(*) = 100 then max(o_orderkey) end as next_after from "
        "(select o_orderkey from orders where o_orderkey > 100 and o_orderstatus = 'F' order by o_orderkey limit 100)"
    ),
    "candle_table": _q(
        CANDLES,
        "select symbol, bar_ts, open, high, low, close, volume from candles where bar_ts between "
        "timestamp '2024-01-10 03:00:00' and timestamp '2024-01-12 06:00:00'",
    ),
    "trade_sink": _TRADED["trades"],
    "equity_sink": _TRADED["equity"],
    "head_tail": _q(
        CANDLES,
        "(select symbol, bar_ts, open, high, low, close, volume, 'head' as part from candles "
        "order by bar_ts, symbol limit 5) union all (select symbol, bar_ts, open, high, low, close, volume, "
        "'tail' as part from candles order by bar_ts desc, symbol desc limit 5)",
    ),
    "bar_index": _q(BARS, "select symbol, bar_ts, idx from bars"),
    "pct_change_4": _ind("pc"),
    "volume_ma": _ind("volume_ma"),
    "volume_percentile": _ind("volume_percentile"),
    "sma_trend": _ind("sma_trend"),
    "sma50": _ind("sma50"),
    "true_range": _ind("tr"),
    "atr": _ind("atr"),
    "avg_atr": _ind("avg_atr"),
    "roc": _ind("roc"),
    "swing_high": _ind("swing_high"),
    "swing_low": _ind("swing_low"),
    "indicators": _ind(
        "pc", "volume_ma", "volume_percentile", "sma_trend", "sma50", "tr", "atr", "roc",
        "swing_high", "swing_low", "avg_atr",
    ),
    "candle_color": _q(
        BARS,
        "select symbol, idx, case when close > open then 'up' when close < open then 'down' end as color from bars",
    ),
    "momentum_cross": _q(
        CROSSINGS,
        "select symbol, idx, side, round(pc, 8) as pc, round(prev_pc, 8) as prev_pc from crossings",
    ),
    "volume_gate": _gate("volume_ok"),
    "trend_gate": _gate("trend_ok"),
    "volatility_gate": _gate("volatility_ok"),
    "trade_condition": _gate("accepted"),
    "zone_origin": _q(CROSSINGS, "select symbol, idx, side, start_idx, top, bot from crossings"),
    "zone_candidates": _q(
        CANDIDATES, "select symbol, side, trigger_idx, start_idx, top, bot from candidates"
    ),
    "min_distance_thin": _q(ZONES, "select symbol, side, trigger_idx from zones", True),
    "order_blocks": _q(ZONES, "select symbol, side, trigger_idx, start_idx, top, bot from zones", True),
    "all_zones": _q(
        ZONES,
        "select symbol, side, count(*) as n, min(bot) as min_bot, max(top) as max_top from zones group by symbol, side",
        True,
    ),
    "last_zone_index": _q(
        ZONES,
        "select symbol, max(case when side = 'bull' then start_idx end) as last_bull_idx, "
        "max(case when side = 'bear' then start_idx end) as last_bear_idx, "
        "greatest(4, max(start_idx)) as resume_idx from zones group by symbol",
        True,
    ),
    "bars_at_zone_start": _q(
        f"{ZONES}, {_signals('origin')}",
        "select b.symbol, b.idx, b.bar_ts, b.close, s.side, s.n_copies from bars b join signals s "
        "on s.symbol = b.symbol and s.idx = b.idx",
        True,
    ),
    "zone_active_bars": _q(
        ZONES,
        "select b.symbol, b.idx, any_value(b.bar_ts) as bar_ts, count(z.symbol) filter (z.side = 'bull') as active_bull, "
        "count(z.symbol) filter (z.side = 'bear') as active_bear from bars b left join zones z "
        "on z.symbol = b.symbol and z.start_idx <= b.idx group by b.symbol, b.idx",
        True,
    ),
    "signals_on_last_bar": _q(
        ZONES,
        "select symbol, max(trigger_idx) as idx, max_by(side, trigger_idx) as side, 1::bigint as n_copies "
        "from zones group by symbol",
        True,
    ),
    "signals_at_polls": _q(
        f"""{ZONES}, {_signals('trigger')}, polls as (
  select symbol, time_bucket(interval '6 hours', bar_ts) + interval '6 hours' as polled_at, max(idx) as idx
  from bars group by symbol, time_bucket(interval '6 hours', bar_ts))""",
        "select symbol, idx, polled_at, side, n_copies from polls join signals using (symbol, idx)",
        True,
    ),
    "zone_overlay": _q(
        f"{ZONES}, r as (select symbol, min(low) as lo, max(high) as hi, max(idx) as last_idx from bars group by symbol)",
        "select symbol, side, trigger_idx, start_idx, last_idx, round((bot - lo) / (hi - lo), 8) as bot_frac, "
        "round((top - lo) / (hi - lo), 8) as top_frac from zones join r using (symbol)",
        True,
    ),
    "first_exit": _q(
        f"""{ZONES}, {_signals('origin')},
pairs as (
  select s.symbol, s.idx as entry_idx, s.side, s.n_copies, e.close as entry_price, b.idx, b.close,
    max(b.close) over later as top, min(b.close) over later as low,
    o.idx is not null as meets
  from signals s
  join bars e on e.symbol = s.symbol and e.idx = s.idx
  join bars b on b.symbol = s.symbol and b.idx > s.idx
  left join signals o on o.symbol = b.symbol and o.idx = b.idx and o.side <> s.side
  where s.idx >= 1
  window later as (partition by s.symbol, s.idx order by b.idx)),
levels as (
  select *, case when side = 'bull' then greatest(entry_price * (1 - 0.02), top * (1 - 0.015))
                 else least(entry_price * (1 + 0.02), low * (1 + 0.015)) end as stop from pairs),
hits as (
  select *, case when side = 'bull' then close <= stop else close >= stop end as stopped from levels),
firsts as (
  select symbol, entry_idx, min(idx) as exit_idx, arg_min(stopped, idx) as stopped, arg_min(stop, idx) as stop
  from hits where stopped or meets group by symbol, entry_idx),
ends as (select symbol, entry_idx, arg_max(stop, idx) as stop from levels group by symbol, entry_idx),
tail as (select symbol, max(idx) as last_idx from bars group by symbol)""",
        """select s.symbol, s.idx as entry_idx, case when s.side = 'bull' then 'long' else 'short' end as type, s.n_copies,
  coalesce(f.exit_idx, tail.last_idx) as exit_idx,
  case when f.exit_idx is null then 'end' when f.stopped then 'stop' else 'opposite' end as exit_kind,
  round(coalesce(f.stop, ends.stop, b.close * (case when s.side = 'bull' then 1 - 0.02 else 1 + 0.02 end)), 8) as last_stop
from signals s join bars b on b.symbol = s.symbol and b.idx = s.idx
left join firsts f on f.symbol = s.symbol and f.entry_idx = s.idx
left join ends on ends.symbol = s.symbol and ends.entry_idx = s.idx
join tail on tail.symbol = s.symbol where s.idx >= 1""",
        True,
    ),
    "nonoverlapping_trades": _q(
        TRADES,
        "select symbol, entry_idx, case when pos = 1 then 'long' else 'short' end as type, exit_idx, "
        "kind as exit_kind from numbered",
        True,
    ),
    "trade_prices": _q(
        TRADES,
        "select symbol, entry_idx, exit_idx, entry_price, entry_time, exit_price, exit_time from trades",
        True,
    ),
    **_TRADED,
    "initial_stop": _q(
        TRADES,
        "select symbol, trade_no, round(entry_price * (case when pos = 1 then 1 - 0.02 else 1 + 0.02 end), 8) "
        "as initial_stop from numbered",
        True,
    ),
    "trailing_stop": _q(
        TRADES,
        "select s.symbol, n.trade_no, s.idx, s.close, round(s.stop_now, 8) as trailing_stop from steps s "
        "join numbered n on n.symbol = s.symbol and s.idx > n.entry_idx and s.idx <= n.exit_idx",
        True,
    ),
    "compounding_capital": _part("entry_capital", "exit_capital"),
    "position_size": _q(
        TRADES,
        "select symbol, trade_no, round(entry_capital * 3.0 / entry_price, 6) as size, "
        "round(entry_capital * 3.0 / entry_price, 4) as size_4 from trades",
        True,
    ),
    "unrealized_pnl": _q(
        TRADES,
        "select n.symbol, n.trade_no, round(pos * (size * c.close - size * entry_price), 6) as unrealized_pnl "
        "from numbered n join (select symbol, max(close) as close from bars group by symbol) c on c.symbol = n.symbol",
        True,
    ),
    "return_pct": _part("return_pct"),
    "completed_trades": _q(
        TRADES, "select symbol, trade_no, exit_reason from trades where pnl is not null", True
    ),
    "winners": _q(TRADES + _SHOWN, "select symbol, trade_no, pnl from shown where pnl > 0", True),
    "losers": _q(TRADES + _SHOWN, "select symbol, trade_no, pnl from shown where pnl < 0", True),
    "trade_markers": _q(TRADES, "select symbol, type, entry_time, entry_price from trades", True),
    "trade_number": _part("entry_idx"),
    "trade_stats": _q(TRADES, f"select {_SYMBOL_STATS} from trades group by symbol", True),
    "trade_stats_overall": _q(TRADES, f"select {_STATS} from trades", True),
    "trade_report": _q(
        f"""{TRADES}, falls as (
  select symbol, (exit_capital - max(exit_capital) over s) / max(exit_capital) over s * 100 as fall
  from trades window s as (partition by symbol order by trade_no)),
worst as (select symbol as sym, round(min(fall), 5) as max_drawdown_pct from falls group by symbol)""",
        f"select {_SYMBOL_STATS}, any_value(max_drawdown_pct) as max_drawdown_pct from trades "
        "join worst on worst.sym = trades.symbol group by symbol",
        True,
    ),
    "running_drawdown": _q(
        TRADES,
        """select symbol, trade_no, round(max(exit_capital) over s, 5) as peak,
  round((exit_capital - max(exit_capital) over s) / max(exit_capital) over s * 100, 5) as drawdown_pct
from trades window s as (partition by symbol order by trade_no)""",
        True,
    ),
    "max_drawdown": _q(
        f"""{TRADES}, curve as (
  select symbol, idx, capital + case when pos <> 0 then pos * (size * close - size * entry_price) else 0 end as equity
  from steps),
falls as (
  select symbol, (equity - max(equity) over s) / max(equity) over s * 100 as fall
  from curve window s as (partition by symbol order by idx))""",
        "select symbol, round(min(fall), 5) as max_drawdown_pct from falls group by symbol",
        True,
    ),
    "pnl_histogram": _q(
        f"""{TRADES}{_SHOWN}, spread as (
  select symbol, case when min(pnl) = max(pnl) then min(pnl) - 0.5 else min(pnl) end as lo,
    case when min(pnl) = max(pnl) then max(pnl) + 0.5 else max(pnl) end as hi from shown group by symbol),
placed as (
  select symbol, least(cast(floor((pnl - lo) / (hi - lo) * 20) as integer) + 1, 20) as bin
  from shown join spread using (symbol)),
every as (select symbol, lo, hi, cast(unnest(range(1, 21)) as integer) as bin from spread)""",
        """select symbol, bin, round(lo + (hi - lo) / 20 * (bin - 1), 10) as bin_lo,
  round(lo + (hi - lo) / 20 * bin, 10) as bin_hi,
  (select count(*) from placed p where p.symbol = every.symbol and p.bin = every.bin) as n from every""",
        True,
    ),
    "trade_list": _q(
        TRADES + _SHOWN,
        """select symbol, trade_no, type, strftime(entry_time, '%Y-%m-%d %H:%M') as entry_time,
  strftime(exit_time, '%Y-%m-%d %H:%M') as exit_time, round(entry_price, 2) as entry_price,
  round(exit_price, 2) as exit_price, round(pnl, 2) as pnl, round(return_pct, 2) as return_pct from shown""",
        True,
    ),
    "price_range": _q(
        CANDLES, "select symbol, min(low) as min_low, max(high) as max_high from candles group by symbol"
    ),
    "last_bar": _q(
        CANDLES,
        "select symbol, max(bar_ts) as last_ts, max_by(close, bar_ts) as last_close from candles group by symbol",
    ),
    "candle_summary": _q(
        CANDLES,
        "select symbol, count(*) as n_bars, min(bar_ts) as first_ts, max(bar_ts) as last_ts from candles group by symbol",
    ),
    "position_from_events": """
with e as (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn,
    case when event_id % 2 = 0 then 1 else -1 end as sign, event_type in ('purchase', 'signup', 'view') as entered
  from events)
select user_id, case when entered then sign else 0 end as position,
  case when entered then value end as entry_price,
  case when entered then round(value * (1 - sign * 0.02), 6) end as stop_loss,
  case when entered then round(value * (1 - sign * 0.015), 6) end as trailing_stop
from e where rn = 1""",
    "order_intents_fractional": f"""
with {LINES}, o as (
  select *, size * discount * case when side = 'sell' then -1 else 1 end as part from lines)
select l_orderkey, l_linenumber, product_id, trunc(part)::bigint as size, side from o where abs(part) >= 1""",
    "order_intents": _q(INTENTS, "select * from intents"),
    "stop_order_intents": _q(
        f"""{LINES}, o as (
  select *, case when discount > 0.01 then price end as lp, case when tax < 0.07 then price end as sp,
    case when discount < 0.09 then discount * 100 end as ta, tax > 0.04 as is_trailing from lines),
p as (
  select *, case when order_type = 'limit_order' and lp is null then 'limit_price is nil'
                 when is_trailing and ta is null then 'trail_amount is nil'
                 when not is_trailing and sp is null then 'stop_price is nil' end as error from o)""",
        """select l_orderkey, l_linenumber, product_id, cast(trunc(size) as bigint) as size, side, order_type,
  'stop_loss_order' as stop_order_type, case when order_type = 'limit_order' then lp end as limit_price,
  round(case when is_trailing then case when side = 'buy' then ta else -ta end end, 4) as trail_amount,
  case when not is_trailing then sp end as stop_price,
  case when error is null then 'ok' else 'error' end as status, error from p""",
    ),
    "order_batches": _q(
        f"""{LINES}, placed as (
  select *, row_number() over (partition by product_id order by l_orderkey, l_linenumber, l_suppkey, size, side,
    order_type, price, discount, tax) - 1 as place from lines)""",
        """select product_id, place // 5 as batch_no, cast(count(*) as integer) as n_orders,
  string_agg(concat_ws(':', l_orderkey, l_linenumber, cast(size as bigint), side), ',' order by place) as orders
from placed group by product_id, place // 5""",
    ),
    "order_json": _q(
        INTENTS,
        """select l_orderkey, l_linenumber, '{"product_id":' || product_id || ',"size":' || size || ',"side":"' || side
  || '","order_type":"' || order_type || '"'
  || coalesce(',"limit_price":"' || regexp_replace(cast(cast(limit_price as decimal(28,8)) as varchar), '\\.?0+$', '') || '"', '')
  || coalesce(',"time_in_force":"' || time_in_force || '"', '')
  || ',"post_only":"' || post_only || '","reduce_only":"' || reduce_only || '"}' as body from intents""",
    ),
    "cancel_intents": "select l_orderkey as id, l_partkey as product_id from lineitem",
    "trade_orders": _q(
        TRADES,
        """select symbol, trade_no, step, case when step = 'entry' then entry_idx else exit_idx end as idx,
  1 as product_id, round(abs(position_size), 6) as size,
  case when (type = 'long') = (step = 'entry') then 'buy' else 'sell' end as side, 'market_order' as order_type,
  case when step = 'exit' then 'true' end as reduce_only
from trades, (values ('entry'), ('exit')) as v(step)""",
        True,
    ),
    "balance_for_asset": (
        "select c_nationkey as asset_id, min(c_custkey) as wallet_id, min_by(c_acctbal, c_custkey) as balance "
        "from customer group by c_nationkey"
    ),
    "first_position": (
        "select o_custkey as product_id, min(o_orderkey) as position_id, 1.0::double as size, "
        "min_by(o_totalprice, o_orderkey) as entry_price from orders group by o_custkey"
    ),
    "alert_text": _q(
        ROUNDED + _SHOWN,
        """select symbol, trade_no, kind, case when kind = 'entry' then
    case when type = 'long' then '🟢 <b>BUY' else '🔴 <b>SELL' end || ' Alert</b>' || chr(10) || chr(10) || 'Symbol: ' || symbol
    || chr(10) || 'Price: MARKET' || chr(10) || 'Size: ' || cast(round(position_size, 8) as varchar)
  else '<b>EXIT Alert</b>' || chr(10) || chr(10) || 'Price: ' || cast(round(exit_price, 2) as varchar) || chr(10)
    || 'PnL: ' || cast(round(pnl, 2) as varchar) || chr(10) || 'Reason: ' || exit_reason end as message
from shown, (values ('entry'), ('exit')) as v(kind)""",
        True,
    ),
    "error_alert": _q(
        CANDLES,
        "select '⚠️ <b>Error Alert</b>' || chr(10) || chr(10) || 'error: unavailable' as message, "
        "count(distinct date_trunc('day', bar_ts)) as n from candles where symbol = 'error'",
    ),
    "startup_message": """
select p_partkey as product_id, concat('🚀 Trading Bot Started!',
  chr(10), 'Product ID: ', p_partkey,
  chr(10), 'Initial Capital: $', regexp_replace(printf('%.6f', p_retailprice::double), '\\.?0+$', ''),
  chr(10), 'Leverage: ', regexp_replace(printf('%.6f', (p_size % 5 + 1) / 2.0), '\\.?0+$', ''), 'x',
  chr(10), 'Order Block Strategy Params:',
  chr(10), '- Candle TF: ', ['1m', '5m', '15m', '1h', '4h', '1d'][p_size % 6 + 1],
  chr(10), '- Price Move Threshold: ', printf('%.2f', (p_size + 1) / 10.0), '%',
  chr(10), '- Min Volume Percentile: 30',
  chr(10), '- SMA Trend: 20/50',
  chr(10), '- Min Candles Between Trades: ', case when p_size = 7 then '?' else '5' end,
  chr(10), '- Stop Loss: 2.00%',
  chr(10), '- Trailing Stop: 1.50%') as message
from part""",
    "round_to_tick": f"select p_partkey, {_tick('t005', '0.05', 2)},{_tick('t05', '0.5', 1)},{_tick('t1', '1', 1)} from part",
}

ORACLES["latest_window_in_folders"] = ORACLES["latest_window"]

# The same rows, whatever the size of the chunks.
ORACLES |= {
    f"{name}_chunked": ORACLES[name]
    for name in ("order_blocks", "first_exit", "trades", "equity", "trailing_stop", "max_drawdown")
}
