"""Sessionization in plain Python, as the yardstick for small fixtures."""

import calendar
from collections import defaultdict


def whole_seconds(instant):
    return calendar.timegm(instant.timetuple())


def sessionize(rows, limit):
    """``rows`` are (user, instant, ...); returns rows + (previous, gap, flag, session).

    Rows of equal user and instant may swap places, so compare as a multiset
    of everything but the trailing input columns.
    """
    by_user = defaultdict(list)
    for row in rows:
        by_user[row[0]].append(row)
    result = []
    for user_rows in by_user.values():
        without = [r for r in user_rows if r[1] is None]
        dated = sorted((r for r in user_rows if r[1] is not None), key=lambda r: r[1])
        result += [(*r, None, None, 1, len(without)) for r in without]
        session, previous = len(without), None
        for row in dated:
            gap = None
            if previous is not None:
                gap = whole_seconds(row[1]) - whole_seconds(previous)
            flag = int(gap is None or gap > limit)
            session += flag
            result.append((*row, previous, gap, flag, session))
            previous = row[1]
    return result


def sessions(rows, limit):
    """(user, session) -> (first, last, seconds)."""
    spans = defaultdict(list)
    for row in sessionize(rows, limit):
        spans[row[0], row[-1]].append(row[1])
    result = {}
    for key, instants in spans.items():
        if instants[0] is None:
            result[key] = (None, None, None)
        else:
            first, last = min(instants), max(instants)
            result[key] = (first, last, whole_seconds(last) - whole_seconds(first))
    return result
