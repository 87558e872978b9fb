"""tripflow: trip-duration data work (clean, split, enrich, fit, score, monitor) as Spark jobs.

Main entry points
-----------------
sources.monthly.read_periods        monthly files with drifting schemas -> one raw table (S1, U1)
sources.tables.write_splits         split table partitioned by split (S3); load_split (S4)
operators.prepare.prepare_training_data   cleaning, duration, input contract (P1-P7)
operators.split.ChronologicalSplit  60/20/20 split by pickup time as pushed-down predicates (W1)
plans.features.TripFeatures         train-only feature statistics as a Spark ML Estimator (M1-M3)
plans.train.fit_pipeline / run_training / random_search   model pipeline, training job, tuning (M4-M7)
plans.scoring.validate_requests / score_requests          JSON requests -> predictions (P16, M9)
streaming.scoring.start_stream_scoring                    the same as a file stream (ST1)
operators.monitor.input_report / quality_report           drift, missing share, quality (D1-D5)
operators.lineage.split_fingerprints / verify_reference_lineage   lineage tags and gate (D7, D8)
plans.monitoring.run_monitoring     the monitoring run with history append (D6)
operators.registry.champion_fold / register_version   alias decisions over model versions (W2)
"""

__version__ = "0.1.0"
