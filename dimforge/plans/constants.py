"""Fixed values of the incident warehouse.

Everything here must equal the original warehouse's values for results to agree
(labels, category lists, calendar range, unknown-member rows). Stated once, in natural
order; both the Spark plans and the DuckDB oracle read them from here.
"""

from __future__ import annotations

import datetime as _dt

# Calendar range of dim_data and the partial (current) year.
CALENDAR_START = _dt.date(2001, 1, 1)
CALENDAR_END = _dt.date(2026, 12, 31)
PARTIAL_YEAR = 2026

# open/closed validity sentinels of SCD2 dimensions.
BEGINNING_OF_TIME = _dt.datetime(1900, 1, 1)
END_OF_TIME = _dt.datetime(9999, 12, 31)

# Unknown-member labels and keys.
UNKNOWN_KEY = "-1"
UNKNOWN_INT = -1
NOT_INFORMED = "Não informado"
NOT_AVAILABLE = "N/D"

# Month names (1..12) and ISO weekday names (1=Monday..7=Sunday), Portuguese.
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAY_NAMES = [
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado", "Domingo",
]
WEEKEND_ISO_DAYS = [6, 7]

# Hour-of-day bands of dim_hora (inclusive bounds, first match wins).
DAY_PERIODS = [(0, 5, "Madrugada"), (6, 11, "Manhã"), (12, 17, "Tarde")]
DAY_PERIOD_ELSE = "Noite"
OPERATIONAL_BANDS = [([(22, 23), (0, 3)], "Horário noturno crítico"), ([(4, 6)], "Madrugada")]
OPERATIONAL_ELSE = "Horário diurno"
NIGHT_HOURS = [(22, 23), (0, 5)]

# Analytic crime category by (historical) primary type, first match wins.
CRIME_CATEGORIES = [
    ("Crime violento", [
        "HOMICIDE", "CRIM SEXUAL ASSAULT", "CRIMINAL SEXUAL ASSAULT",
        "ASSAULT", "BATTERY", "ROBBERY", "KIDNAPPING",
        "OFFENSE INVOLVING CHILDREN", "HUMAN TRAFFICKING",
        "INTIMIDATION", "STALKING", "SEX OFFENSE",
    ]),
    ("Crime patrimonial", [
        "THEFT", "BURGLARY", "MOTOR VEHICLE THEFT", "ARSON",
        "CRIMINAL DAMAGE", "CRIMINAL TRESPASS", "DECEPTIVE PRACTICE",
    ]),
    ("Entorpecentes", ["NARCOTICS", "OTHER NARCOTIC VIOLATION"]),
    ("Armas", ["WEAPONS VIOLATION", "CONCEALED CARRY LICENSE VIOLATION"]),
]
CRIME_CATEGORY_ELSE = "Outros"
VIOLENT_CATEGORY = "Crime violento"

# Location category by substring of the location text, first match wins.
LOCATION_CATEGORIES = [
    ("Residencial", ["RESIDENCE", "APARTMENT", "HOUSE", "PORCH", "YARD"]),
    ("Via pública", ["STREET", "SIDEWALK", "ALLEY", "HIGHWAY", "BRIDGE"]),
    ("Comercial", ["STORE", "RESTAURANT", "BAR", "COMMERCIAL", "GAS STATION", "BANK", "HOTEL"]),
    ("Educacional", ["SCHOOL", "COLLEGE", "UNIVERSITY"]),
    ("Transporte público", ["CTA", "TRAIN", "BUS", "AIRPORT", "TAXI"]),
    ("Área de lazer", ["PARK", "LAKEFRONT"]),
    ("Veículo / estacionamento", ["VEHICLE", "AUTO", "PARKING"]),
]
LOCATION_CATEGORY_ELSE = "Outros"
PUBLIC_PLACE_WORDS = ["STREET", "SIDEWALK", "ALLEY", "PARK"]

# Junk-dimension labels for the arrest / domestic flags.
ARREST_LABELS = ("Com prisão", "Sem prisão")
DOMESTIC_LABELS = ("Violência doméstica", "Não doméstico")
COMBINED_FLAG_LABELS = [
    (True, True, "Doméstico com prisão"),
    (True, False, "Não doméstico com prisão"),
    (False, True, "Doméstico sem prisão"),
    (False, False, "Não doméstico sem prisão"),
]

# Districts deactivated in the 2012 consolidation; display prefixes.
DEACTIVATED_DISTRICTS = [13, 21, 23]
DISTRICT_PREFIX = "Distrito "
WARD_PREFIX = "Ward "
QUARTER_PREFIX = "T"

# Ward / community coverage starts in this year.
WARD_COVERAGE_FROM = 2003
