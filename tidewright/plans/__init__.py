"""Jobs composed from the operators: master tables, treated tables, features, forecasts, audit."""
