"""Jobs run against stored tables: append, overwrite, and new versions of what they read."""

from datetime import date

import pytest

from cashloom.plans.cash import RunState, cashflow_close, cashflow_current_month, cashflow_initial
from cashloom.plans.posting import post_payments
from cashloom.plans.schedules import payables_schedule
from cashloom.sources import staging
from workload.frames import Frames

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, tmp_path):
    class Tables:
        def path(self, name):
            return str(tmp_path / name)

        def read(self, name):
            return spark.read.parquet(self.path(name))

        def append(self, df, name):
            df.write.mode("append").parquet(self.path(name))

    return Tables()


def test_months_accumulate_in_the_history(spark, tables):
    f = Frames(spark, FOLDER)
    flows = f.receipts_posted(), f.payments_posted()
    first = cashflow_initial(*flows, RunState(date(1999, 2, 10), 0))
    tables.append(first.daily, "daily")
    tables.append(first.monthly, "monthly")
    for today in (date(1999, 3, 1), date(1999, 3, 20), date(1999, 7, 4), date(2000, 1, 5)):
        closed = cashflow_close(*flows, tables.read("daily"), tables.read("monthly"), RunState(today, 1))
        # both halves are computed before either table grows
        daily, monthly = staging.shared_copy(closed.daily), staging.shared_copy(closed.monthly)
        tables.append(daily, "daily")
        tables.append(monthly, "monthly")
    whole = cashflow_initial(*flows, RunState(date(2000, 1, 5), 0))
    for name, expected, columns in (
        ("daily", whole.daily, ["DATA", "ENTRADA", "SAIDA", "ACUMULADO_DIARIO"]),
        ("monthly", whole.monthly, ["DATA_FECHAMENTO", "ANO", "MES", "ENTRADA", "SAIDA", "VALOR_ACUMULADO_MES"]),
    ):
        found = tables.read(name).select(columns)
        assert found.count() == expected.count() > 0
        assert found.exceptAll(expected.select(columns)).count() == 0
    view = cashflow_current_month(*flows, tables.read("daily"), tables.read("monthly"), RunState(date(2000, 1, 20), 1))
    for _ in range(2):
        view.write.mode("overwrite").parquet(tables.path("open_month"))
    stored = tables.read("open_month")
    assert stored.count() == view.count() > 0
    last = tables.read("daily").orderBy("DATA", ascending=False).first().ACUMULADO_DIARIO
    total = stored.selectExpr("sum(ENTRADA) - sum(SAIDA)").first()[0]
    assert stored.orderBy("DATA", ascending=False).first().ACUMULADO_DIARIO == last + total


def test_schedule_versions(spark, tables):
    f = Frames(spark, FOLDER)
    invoices, terms = f.invoices("ID_NF_ENTRADA"), f.terms()
    empty = spark.createDataFrame([], "ID_NF_ENTRADA long, DATA_VENCIMENTO date")
    tables.append(payables_schedule(invoices, terms, empty), "schedule")
    count = tables.read("schedule").count()
    tables.append(payables_schedule(invoices, terms, tables.read("schedule")), "schedule")
    assert tables.read("schedule").count() == count
    version = f.payable_schedule()
    open_before = version.where("STATUS_PAGAMENTO = 0").count()
    posted = post_payments(f.payment_file(), version)
    tables.append(posted.schedule, "version2")
    settled = posted.history.select("ID_PROG_PAGAMENTO").distinct().count()
    assert tables.read("version2").where("STATUS_PAGAMENTO = 0").count() == open_before - settled
    assert post_payments(f.payment_file(), tables.read("version2")).history.count() == 0


def test_shared_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") in staging.shared_folder(spark)
