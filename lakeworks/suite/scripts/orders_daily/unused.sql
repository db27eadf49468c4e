SELECT 1 AS never_run
