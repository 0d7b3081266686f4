"""All registered queries and comparison SQL, joined from the topic modules."""

from checks import oracle_data, oracle_reports, oracle_views, q_data, q_reports, q_views

QUERIES = {**q_views.QUERIES, **q_reports.QUERIES, **q_data.QUERIES}
ORACLES = {**oracle_views.VIEWS, **oracle_reports.SQL, **oracle_data.SQL}
