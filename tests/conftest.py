import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("riskloom-tests", 4, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def application_rows(n, shift=0.0):
    """Small application rows; every tenth is positive and looks different."""
    rows = []
    for i in range(n):
        bad = 1 if i % 10 == 0 else 0
        rows.append(
            dict(
                fraud_bool=bad,
                income=0.1 + (i % 9) / 10 + shift,
                name_email_similarity=0.2 if bad else 0.8,
                prev_address_months_count=-1 if i % 3 == 0 else 12 + i % 5,
                current_address_months_count=3 if bad else 60 + i % 7,
                customer_age=20 + 10 * (i % 5),
                days_since_request=i % 30,
                intended_balcon_amount=-1.0 if i % 4 == 0 else 10.0 + i,
                payment_type="AB" if i % 2 else "AA",
                zip_count_4w=1000 + i,
                velocity_6h=4000.0 + 10 * i + 5000 * shift,
                velocity_24h=5000.0 + 11 * i + 5000 * shift,
                velocity_4w=6000.0 + 12 * i,
                bank_branch_count_8w=i % 12,
                date_of_birth_distinct_emails_4w=i % 15,
                employment_status="CA" if i % 3 else "CB",
                credit_risk_score=200.0 if bad else 80.0 + i % 10,
                email_is_free=bad,
                housing_status="BA",
                phone_home_valid=1 - bad,
                phone_mobile_valid=1 - bad,
                bank_months_count=2 if bad else 20,
                has_other_cards=i % 2,
                proposed_credit_limit=1500.0 if bad else 200.0,
                foreign_request=bad,
                source="INTERNET",
                session_length_in_minutes=-1.0 if i % 7 == 0 else 4.5,
                device_os="linux" if i % 2 else "windows",
                keep_alive_session=1 - bad,
                device_distinct_emails_8w=1,
                device_fraud_count=bad,
                month=i % 8,
            )
        )
    return rows


@pytest.fixture(scope="session")
def applications(spark):
    from riskloom.operators.presets import APPLICATION_SCHEMA

    def make(n=120, shift=0.0):
        rows = application_rows(n, shift)
        return spark.createDataFrame([tuple(r[f] for f in APPLICATION_SCHEMA.fieldNames()) for r in rows], APPLICATION_SCHEMA)

    return make
