from evenline.plans.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
