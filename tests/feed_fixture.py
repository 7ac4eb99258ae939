"""A hand-made exchange feed: one football event, five markets, bz2 JSON lines.

Times (UTC): definitions at 13:00, kick-off (first in-play) at 14:00, first
goal settles the 0.5-goals market at 14:25, full time at 15:50.

Expected by hand: kick-off 14:00, first goal minute 25, final score 2-1,
total goals 3, result HOME; home pre-kick-off back price at ladder position 1
is 1.98 with volume 1000 (the 13:59:40 change is inside the 30 s lag).
"""

from __future__ import annotations

import bz2
import datetime as dt
import json
import os

EVENT_ID = "29301"
T0 = int(dt.datetime(2025, 3, 1, 14, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
MIN = 60_000


def iso(ms: int) -> str:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z")


MARKETS = {
    "1.1": ("MATCH_ODDS", "Match Odds", [(11, "Home", 1), (12, "Away", 2), (13, "The Draw", 3)]),
    "1.2": ("OVER_UNDER_05", "Over/Under 0.5 Goals", [(21, "Under 0.5 Goals", 1), (22, "Over 0.5 Goals", 2)]),
    "1.3": ("OVER_UNDER_25", "Over/Under 2.5 Goals", [(31, "Under 2.5 Goals", 1), (32, "Over 2.5 Goals", 2)]),
    "1.4": ("CORRECT_SCORE", "Correct Score", [(41, "2 - 1", 1), (42, "Any Other Home Win", 2)]),
    "1.5": ("CORRECT_SCORE2", "Correct Score 2", [(51, "2 - 1", 1), (52, "Any unquoted", 2)]),
}


def definition(market_id: str, version: int, in_play: bool, status: str, winners=(), settled: int | None = None,
               name_override: str | None = "default"):
    mtype, name, runners = MARKETS[market_id]
    closed = status == "CLOSED"
    return {
        "betDelay": 5 if in_play else 0, "bettingType": "ODDS", "bspMarket": False, "bspReconciled": False,
        "complete": True, "countryCode": "GB", "crossMatching": True, "discountAllowed": True,
        "eventId": EVENT_ID, "eventName": "Home v Away", "eventTypeId": "1", "inPlay": in_play,
        "marketBaseRate": 5.0, "marketTime": iso(T0), "marketType": mtype,
        "name": name if name_override == "default" else name_override,
        "numberOfActiveRunners": len(runners), "numberOfWinners": 1, "openDate": iso(T0),
        "persistenceEnabled": True, "regulators": ["MR_INT"],
        "runners": [
            {"hc": 0.0, "id": rid, "name": rname, "sortPriority": sp,
             "status": ("WINNER" if rid in winners else "LOSER") if closed else "ACTIVE"}
            for rid, rname, sp in runners
        ],
        "runnersVoidable": False, "settledTime": iso(settled) if settled else None, "status": status,
        "suspendTime": iso(T0), "timezone": "GMT", "turnInPlayEnabled": True, "version": version,
    }


def msg(pt: int, changes: list[dict]) -> dict:
    return {"op": "mcm", "clk": str(pt), "pt": pt, "mc": changes}


def rc(rid, batb=None, batl=None, ltp=None, tv=None):
    d = {"id": rid, "hc": 0.0}
    if batb is not None:
        d["batb"] = batb
    if batl is not None:
        d["batl"] = batl
    if ltp is not None:
        d["ltp"] = ltp
    if tv is not None:
        d["tv"] = tv
    return d


def messages() -> list[dict]:
    pre = T0 - 60 * MIN
    out = [msg(pre, [{"id": m, "marketDefinition": definition(m, 1, False, "OPEN")} for m in MARKETS])]
    out.append(msg(T0 - 10 * MIN, [{"id": "1.1", "rc": [
        rc(11, batb=[[0, 2.0, 100.0], [1, 1.98, 50.0], [2, 1.96, 10.0]], batl=[[0, 2.02, 80.0]], ltp=2.0, tv=1000.0),
        rc(12, batb=[[0, 4.0, 30.0], [1, 3.9, 20.0]], ltp=4.1, tv=400.0),
        rc(13, batb=[[0, 3.5, 25.0], [1, 3.45, 5.0]], batl=[[0, 3.6]], ltp=3.5, tv=300.0),
    ]}]))
    # 20 s before kick-off: inside the 30 s lag of the match statistics
    out.append(msg(T0 - 20_000, [{"id": "1.1", "rc": [rc(11, batb=[[1, 1.99, 60.0]], ltp=1.99, tv=1100.0)]}]))
    out.append(msg(T0, [{"id": m, "marketDefinition": definition(m, 2, True, "OPEN")} for m in MARKETS]))
    # an empty and a missing change list
    out.append({"op": "mcm", "clk": "x", "pt": T0 + 1000, "mc": []})
    out.append({"op": "heartbeat", "clk": "y", "pt": T0 + 2000})
    goal = T0 + 25 * MIN
    out.append(msg(goal, [{"id": "1.2", "marketDefinition": definition("1.2", 3, True, "CLOSED", winners=(22,),
                                                                      settled=goal)}]))
    for minute, odds in ((27, 1.5), (29, 1.45), (31, 1.4)):
        out.append(msg(T0 + minute * MIN, [{"id": "1.1", "rc": [rc(11, batb=[[0, odds, 200.0]], ltp=odds,
                                                                   tv=2000.0 + minute)]}]))
    ft = T0 + 110 * MIN
    final = {"1.1": (11,), "1.3": (32,), "1.4": (41,), "1.5": (51,)}
    out.append(msg(ft, [{"id": m, "marketDefinition": definition(m, 4, True, "CLOSED", winners=w, settled=ft)}
                        for m, w in final.items()]))
    return out


def write_feed(root: str) -> str:
    """Write the feed under ``root``: the per-event file, a copy of one message
    in a second event file, and a per-market file that must be skipped."""
    os.makedirs(os.path.join(root, "2025", "3"), exist_ok=True)
    os.makedirs(os.path.join(root, "copies"), exist_ok=True)
    msgs = messages()

    def dump(path, items):
        with bz2.open(path, "wt") as f:
            for m in items:
                f.write(json.dumps(m) + "\n")

    dump(os.path.join(root, "2025", "3", f"{EVENT_ID}.bz2"), msgs)
    dump(os.path.join(root, "copies", f"{EVENT_ID}.bz2"), [msgs[1]])
    dump(os.path.join(root, "2025", "3", "1.2345.bz2"), [msg(T0 + 5 * MIN, [{"id": "9.9", "rc": [rc(99, ltp=9.0)]}])])
    return root
