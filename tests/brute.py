"""The operators' meanings on plain Python rows, by trying every pair."""

from __future__ import annotations

from collections import Counter
from datetime import date, timedelta
from random import Random

DAY0 = date(2000, 1, 1)


def day(number: int) -> date:
    return DAY0 + timedelta(days=number)


def cohort_rows(members, periods, deaths, label="within", or_death=False):
    """Members are (person, concept, date); periods and deaths by person."""
    rows = []
    for person, concept, onset in members:
        matching = [
            died
            for dead, died in deaths
            if dead == person
            and (
                0 <= (died - onset).days <= 360
                if label == "within"
                else (onset - died).days > 360
            )
        ]
        for observed, start, end in periods:
            if observed != person or (onset - start).days <= 360:
                continue
            for died in matching or [None]:
                followed = (end - onset).days > 360
                if followed or (or_death and died is not None and onset <= end):
                    rows.append((person, concept, onset, died))
    return Counter(rows)


def lookback_rows(cohort, events, categories, lookback=(0, 360)):
    """Cohort rows are (person, onset); events (person, concept, date)."""
    rows = []
    for person, onset in cohort:
        met = [
            concept
            for who, concept, when in events
            if who == person and lookback[0] <= (onset - when).days <= lookback[1]
        ]
        for concept in met or [None]:
            names = [name for known, name in categories if known == concept]
            rows += [(person, name) for name in names or [None]]
    return Counter(rows)


def random_history(seed: int, persons: int = 40, hot: int = 400):
    """Members, periods, deaths and events; person 0 holds a large part of them."""
    random = Random(seed)

    def someone() -> int:
        return 0 if random.random() < 0.33 else random.randrange(persons)

    members = [(someone(), random.choice([1, 2, 3]), day(random.randrange(1500))) for _ in range(hot)]
    members += random.choices(members, k=hot // 4)
    periods = []
    for person in range(persons):
        for _ in range(random.choice([0, 1, 1, 2])):
            start = random.randrange(-400, 900)
            periods.append((person, day(start), day(start + random.randrange(0, 1800))))
    periods += random.choices(periods, k=5)
    deaths = [(person, day(random.randrange(2000))) for person in range(0, persons, 2)]
    deaths += [(0, day(700)), (0, day(700)), (2, day(900))]
    events = [(someone(), random.choice([1, 2, 3, 4]), day(random.randrange(-500, 2200))) for _ in range(hot)]
    events += random.choices(events, k=hot // 3)
    return members, periods, deaths, events
