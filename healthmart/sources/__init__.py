from .schemas import SCHEMAS, WAREHOUSE_SCHEMAS, VARCHAR_LIMITS
from .tables import Catalog, append_rows, load
from .roles import RoleViews, role_views

__all__ = ["SCHEMAS", "WAREHOUSE_SCHEMAS", "VARCHAR_LIMITS", "Catalog", 
           "append_rows", "load", "RoleViews", "role_views"]
