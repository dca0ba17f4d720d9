"""KPI operators: scalar KPIs, KPI tables, dashboard views, extensions."""
