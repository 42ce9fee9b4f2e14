"""The bucket calendar of one cut, worked out row by row over Python lists."""

from __future__ import annotations

import datetime as dt

WEEKDAYS = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")


def make_calendar(first: dt.date, last: dt.date, holidays=(), saturday_flag=1, missing=(), unnamed=()):
    """(date, flag, weekday) rows; ``unnamed`` days have no weekday."""
    rows = []
    day = first
    while day <= last:
        if day not in missing:
            off = day.weekday() == 6 or day in holidays or (day.weekday() == 5 and not saturday_flag)
            rows.append((day, 0 if off else 1, None if day in unnamed else WEEKDAYS[day.weekday()]))
        day += dt.timedelta(days=1)
    return rows


def as_frame(spark, rows):
    data = [(int(d.strftime("%Y%m%d")), d, flag, name) for d, flag, name in rows]
    return spark.createDataFrame(data, "id_dh_fecha int, fec_fecha_iso date, flg_dia_habil int, nom_dia_semana string")


def _working(row):
    return row[1] == 1 and row[2] not in (None, "sábado")


def backward(rows, cut):
    before = [r for r in rows if r[0] < cut]
    window, prior = before[-4:], before[-8:-4]
    out = []
    for i, (day, flag, name) in enumerate(prior):
        if not (flag == 0 or name == "sábado"):
            continue
        if name in (None, "jueves") and flag == 0:
            # NOT (jueves AND next is viernes AND next works): what is unknown is neither true nor false and drops the day.
            after = prior[i + 1] if i + 1 < len(prior) else (None, None, None)
            tests = [None if name is None else True, None if after[2] is None else after[2] == "viernes", None if after[1] is None else after[1] == 1]
            if False not in tests:
                continue
        out.append((name, day, 1))
    business = working = off = 0
    for position, (day, flag, name) in enumerate(window, start=1):
        business += flag == 1
        adjusted = 0 if name == "sábado" else flag
        if adjusted == 1:
            working += 1
            bucket = business
        else:
            off += 1
            bucket = 5 if name == "jueves" else position - off + 1
        out.append((name, day, bucket))
    out += [(name, day, 5 if flag == 1 else 8) for day, flag, name in rows if day == cut]
    return out


def forward(rows, cut):
    later = [r for r in rows if r[0] > cut]
    following = next((r[0] for r in later if _working(r)), None)
    if following is None:
        return []
    out = [("1" if _working(r) else r[2], r[0], 8) for r in later if r[0] <= following]
    for shift, count, label, bucket in ((0, 6, 1, None), (6, 8, 7, 16), (14, 15, 15, 17), (29, 60, 30, 19), (89, 275, 90, 20)):
        start = following + dt.timedelta(days=shift)
        for n, row in enumerate([r for r in rows if r[0] > start][:count], start=1):
            out.append((str(n + label), row[0], n + 8 if bucket is None else bucket))
    return out


def buckets(rows, cut):
    return sorted(backward(rows, cut) + forward(rows, cut), key=str)
