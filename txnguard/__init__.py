"""txnguard: Spark-native transaction risk scoring and reporting.

Entry points: `plans.pipeline.Pipeline` (lazy batch pipeline), `plans.batch_job.run_batch`
(end-to-end batch run), `streaming.job.start_pipeline` (Structured Streaming job),
`operators.*` (history, scoring, marts, lookup tables, dashboard, quality checks).
"""

__version__ = "0.1.0"
