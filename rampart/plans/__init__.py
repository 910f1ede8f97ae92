from .pipeline import l0_to_l1, l1_to_target, rcv_to_l0, run_stage, run_table

__all__ = ["l0_to_l1", "l1_to_target", "rcv_to_l0", "run_stage", "run_table"]
