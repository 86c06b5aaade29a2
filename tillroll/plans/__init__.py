from tillroll.plans.materialize import checkpoint_dir, reliable_checkpoint, write_and_read  # noqa: F401
from tillroll.plans.pipeline import PUBLISHED, REPORT, build_tables, register_views, run_pipeline  # noqa: F401
