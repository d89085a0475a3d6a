"""Values that results depend on."""

# They define the data contract and must not be changed.

MONTH_NAMES = [
    "janeiro", "fevereiro", "marco", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]

# Monday first.
WEEKDAY_NAMES = ["segunda", "terca", "quarta", "quinta", "sexta", "sabado", "domingo"]

COUNTRY_SYNONYMS = {
    "EUA": "ESTADOS UNIDOS",
    "USA": "ESTADOS UNIDOS",
    "ESTADOS UNIDOS DA AMERICA": "ESTADOS UNIDOS",
    "INGLATERRA": "REINO UNIDO",
    "UK": "REINO UNIDO",
}

COUNTRY_CURRENCY = {
    "ARGENTINA": "ARS",
    "BRASIL": "BRL",
    "CANADA": "CAD",
    "ESTADOS UNIDOS": "USD",
    "FRANCA": "EUR",
    "PORTUGAL": "EUR",
    "REINO UNIDO": "GBP",
}

HOME_CURRENCY = "BRL"

# Sell rate used for every Argentine amount, whatever the day.
ARS_SELL_RATE = 0.0037

# Words that stay in lower case inside a person's name.
NAME_PARTICLES = ["da", "das", "de", "do", "dos", "e"]

# Texts a CSV cell may hold for a missing value.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

VALUE_BANDS = ["medio_baixo_valor", "alto_valor", "muito_alto_valor"]

# Recency given to clients with receivables but no payment yet.
NEVER_PAID_DAYS = 9999
