"""Measures over (place, day) series: shares, highest values, totals and running totals.

``cases`` has one row per place and day with ``continent``, ``location``, ``date``,
``population``, ``total_cases``, ``new_cases`` and, as text, ``total_deaths`` and
``new_deaths``; ``vaccinations`` has ``location``, ``date`` and, as text,
``new_vaccinations``. Rows without a continent are sums over several places.

Shares are in percent and NULL where the divisor is zero. The names of the columns read and made
are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def places(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("continent").isNotNull())


def all_rows(cases: DataFrame) -> DataFrame:
    return places(cases).orderBy("location", "date")


def overview(cases: DataFrame) -> DataFrame:
    return (
        places(cases)
        .select("location", "date", "total_cases", "new_cases", "total_deaths", "population")
        .orderBy("location", "date")
    )


def death_percentage(cases: DataFrame, place_like: str) -> DataFrame:
    """Share of the cases so far that died, for the places matching a LIKE pattern."""
    return (
        places(cases)
        .where(F.col("location").like(place_like))
        .select(
            "location",
            "date",
            "total_cases",
            "total_deaths",
            percent(F.col("total_deaths").cast("double"), F.col("total_cases")).alias(
                "DeathPercentage"
            ),
        )
        .orderBy("location", "date")
    )


def case_percentage(cases: DataFrame, place_like: str) -> DataFrame:
    return (
        places(cases)
        .where(F.col("location").like(place_like))
        .select(
            "location",
            "date",
            "total_cases",
            "population",
            percent(F.col("total_cases"), F.col("population")).alias("CasesPercentage"),
        )
        .orderBy("location", "date")
    )


def infection_rate(cases: DataFrame) -> DataFrame:
    """Highest number of cases and highest share of the population, by place."""
    share = F.try_divide(F.col("total_cases"), F.col("population"))
    return (
        places(cases)
        .groupBy("location", "population")
        .agg(
            F.max("total_cases").alias("HighestInfectionCount"),
            (F.max(share) * 100).alias("PercentPopulationInfected"),
        )
        .orderBy(F.desc("PercentPopulationInfected"))
    )


def highest_deaths(rows: DataFrame, by: str, lenient: bool = False) -> DataFrame:
    """Highest death count by place or continent.

    The counts are text and are compared as numbers. Text that is no whole number stops
    the job, or counts as missing if ``lenient``.
    """
    deaths = F.col("total_deaths")
    deaths = deaths.try_cast("int") if lenient else deaths.cast("int")
    return (
        rows.groupBy(by)
        .agg(F.max(deaths).alias("TotalDeathCount"))
        .orderBy(F.desc("TotalDeathCount"))
    )


def deaths_by_location(cases: DataFrame) -> DataFrame:
    return highest_deaths(places(cases), "location")


def deaths_by_aggregate(cases: DataFrame) -> DataFrame:
    """The same for the rows that are sums over places."""
    return highest_deaths(cases.where(F.col("continent").isNull()), "location")


def deaths_by_continent(cases: DataFrame) -> DataFrame:
    return highest_deaths(places(cases), "continent")


def _sums() -> tuple[Column, Column]:
    return F.sum("new_cases"), F.sum(F.col("new_deaths").cast("int"))


def global_by_date(cases: DataFrame) -> DataFrame:
    new_cases, new_deaths = _sums()
    return (
        places(cases)
        .groupBy("date")
        .agg(
            new_cases.alias("total_cases"),
            new_deaths.alias("total_deaths"),
            percent(new_deaths, new_cases).alias("DeathPercentage"),
        )
        .orderBy("date", "total_cases")
    )


def global_numbers(cases: DataFrame) -> DataFrame:
    new_cases, new_deaths = _sums()
    return places(cases).agg(
        new_cases.alias("total_cases"),
        new_deaths.alias("total_deaths"),
        percent(new_deaths, new_cases).alias("DeathPercentage"),
    )


def global_population(cases: DataFrame) -> DataFrame:
    """Global sums against the population.

    The population is added once per row, that is once per place and day, so the
    denominators are person-days.
    """
    new_cases, new_deaths = _sums()
    population = F.sum("population")
    return places(cases).agg(
        population.alias("GlobalPopulation"),
        new_cases.alias("total_new_cases"),
        new_deaths.alias("total_new_deaths"),
        percent(new_cases, population).alias("GlobalInfectedPopulation"),
        percent(new_deaths, population).alias("GlobalDeathPopulation"),
        percent(new_deaths, new_cases).alias("InfestationDeathPercentage"),
    )


def running_by_day(daily: DataFrame, place: str, day: str, value: str, name: str) -> DataFrame:
    """Running total over the days of each place, for one row per place and day.

    The window holds a whole place, which is safe only because a place has no more rows
    than there are days; a finer column must be reduced to days first.
    """
    if not isinstance(daily.schema[day].dataType, T.DateType):
        raise TypeError(f"{day} must be a DATE, or one place could fill a task")
    days_of_place = Window.partitionBy(place).orderBy(day)
    return daily.select(place, day, F.sum(value).over(days_of_place).alias(name))


def running_vaccinations(cases: DataFrame, vaccinations: DataFrame) -> DataFrame:
    """Case rows joined to vaccination rows, with the place's vaccinations up to that day.

    Rows of one day share the running total. It is summed over joined rows: a day with
    several rows on the other side counts that often. Both sides are therefore reduced to
    days before they meet, so that the running total never sees more than one row per
    place and day however many rows a place has.
    """
    doses = F.col("new_vaccinations").cast("bigint")
    case_days = places(cases).groupBy("location", "date").agg(F.count(F.lit(1)).alias("n_cases"))
    dose_days = vaccinations.groupBy("location", "date").agg(F.sum(doses).alias("doses"))
    daily = case_days.join(dose_days, ["location", "date"]).select(
        "location", "date", (F.col("doses") * F.col("n_cases")).alias("doses")
    )
    totals = running_by_day(daily, "location", "date", "doses", "SumOfPeopleVaccination")
    return (
        places(cases)
        .join(vaccinations, ["location", "date"])
        .join(totals, ["location", "date"])
        .select(
            "continent",
            "location",
            "date",
            "population",
            "new_vaccinations",
            "SumOfPeopleVaccination",
        )
    )


# Columns of the vaccination report, and their types where it is kept in a
# typed table. The first name is spelt as its users know it.
REPORT_COLUMNS = (
    "Continet", "Location", "Date", "Population", "New_Vaccinations", "SumOfPeopleVaccination",
)
REPORT_TYPES = (
    "string", "string", "timestamp_ntz", "decimal(18,0)", "decimal(18,0)", "decimal(18,0)",
)


def with_vaccinated_percentage(report: DataFrame) -> DataFrame:
    """The report with the share of the population; ordered by place and day."""
    return report.select(
        "*",
        percent(
            F.col("SumOfPeopleVaccination").cast("double"), F.col("Population").cast("double")
        ).alias("PercentOfVaccinations"),
    ).orderBy("Location", "Date")


def vaccination_report(cases: DataFrame, vaccinations: DataFrame) -> DataFrame:
    """Columns renamed by position."""
    return running_vaccinations(cases, vaccinations).toDF(*REPORT_COLUMNS)
