"""sortproof: generate, totally sort and verify byte-keyed records on Spark.

The main entry points, re-exported::

    from sortproof import (generate_records, total_order_sort, validate,
                           read_fixed_records, write_fixed_records, jobs)
"""

__version__ = "0.1.0"

from sortproof import jobs  # noqa: E402,F401
from sortproof.operators.generate import generate_records, with_records  # noqa: E402,F401
from sortproof.operators.partition import (assign_partition, block_sample,  # noqa: E402,F401
                                           file_block_sample, file_spread_sample,
                                           split_points)
from sortproof.operators.sort import (global_position, sort_with_global_position,  # noqa: E402,F401
                                      total_order_sort)
from sortproof.operators.validate import (checksum_total, compare_checksums,  # noqa: E402,F401
                                          file_summary, misorders, validate)
from sortproof.sources.fixed_record import (global_positions, read_fixed_records,  # noqa: E402,F401
                                            write_fixed_records)
from sortproof.sources.inventory import inventory  # noqa: E402,F401
