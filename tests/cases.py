"""Moments that tests of objects and states share."""

import datetime

BASE = datetime.datetime(2026, 9, 1, 12, tzinfo=datetime.timezone.utc)


def minutes(number):
    return BASE + datetime.timedelta(minutes=number)


def iso(number):
    return minutes(number).isoformat()
