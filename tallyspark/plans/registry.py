"""The query registry: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from tallyspark.plans import cleaning, io_jobs, retail, sales, staff, stored

QUERIES = {
    "customer_dashboard": sales.customer_dashboard,
    "customer_totals": sales.customer_totals,
    "above_avg_orders": sales.above_avg_orders,
    "max_order_per_customer_ties": sales.max_order_per_customer_ties,
    "above_avg_customers": sales.above_avg_customers,
    "rank_customers": sales.rank_customers,
    "dense_rank_customers": sales.dense_rank_customers,
    "customer_quartile": sales.customer_quartile,
    "customer_scorecard": sales.customer_scorecard,
    "order_sequence": sales.order_sequence,
    "dense_top3": sales.dense_top3,
    "rank_top5": sales.rank_top5,
    "rank_bottom5": sales.rank_bottom5,
    "single_order_customers": sales.single_order_customers,
    "above_avg_margin": sales.above_avg_margin,
    "top_order_per_customer": sales.top_order_per_customer,
    "top_k_orders": sales.top_k_orders,
    "star_dim_customer": sales.star_dim_customer,
    "star_dim_product": sales.star_dim_product,
    "star_fact": sales.star_fact,
    "dim_key_conflicts": sales.dim_key_conflicts,
    "scan_parquet": retail.scan_parquet,
    "project_cols": retail.project_cols,
    "distinct_values": retail.distinct_values,
    "head_n": retail.head_n,
    "tail_n": retail.tail_n,
    "sort_multi": retail.sort_multi,
    "filter_eq": retail.filter_eq,
    "filter_range": retail.filter_range,
    "filter_and": retail.filter_and,
    "filter_or": retail.filter_or,
    "filter_between_date": retail.filter_between_date,
    "filter_date_halfopen": retail.filter_date_halfopen,
    "date_parts": retail.date_parts,
    "round_abs": retail.round_abs,
    "global_agg": retail.global_agg,
    "agg_by_status": retail.agg_by_status,
    "agg_by_segment": retail.agg_by_segment,
    "price_range_by_type": retail.price_range_by_type,
    "having_avg": retail.having_avg,
    "revenue_by_category": retail.revenue_by_category,
    "status_pivot": retail.status_pivot,
    "status_summary": retail.status_summary,
    "price_tier": retail.price_tier,
    "table_row_counts": retail.table_row_counts,
    "executive_kpis": retail.executive_kpis,
    "join_inner": retail.join_inner,
    "join_three_way": retail.join_three_way,
    "join_left": retail.join_left,
    "join_right": retail.join_right,
    "join_full_audit": retail.join_full_audit,
    "orphan_items": retail.orphan_items,
    "orders_without_items": retail.orders_without_items,
    "dq_duplicate_key": retail.dq_duplicate_key,
    "dq_range": retail.dq_range,
    "dq_domain": retail.dq_domain,
    "dq_length": retail.dq_length,
    "revenue_reconcile": retail.revenue_reconcile,
    "apply_updates": retail.apply_updates,
    "append_rows": retail.append_rows,
    "inline_values": retail.inline_values,
    "cross_pivot": retail.cross_pivot,
    "staff_by_department": staff.staff_by_department,
    "cross_segment_region": staff.cross_segment_region,
    "salary_band": staff.salary_band,
    "experience_level": staff.experience_level,
    "bonus": staff.bonus,
    "rename_cast": staff.rename_cast,
    "parse_date": staff.parse_date,
    "tenure_months": staff.tenure_months,
    "impute_mean": staff.impute_mean,
    "impute_approx_median": staff.impute_approx_median,
    "fill_constants": staff.fill_constants,
    "impute_by_dtype": staff.impute_by_dtype,
    "drop_null_rows": staff.drop_null_rows,
    "dedup_exact": staff.dedup_exact,
    "dedup_subset_keep_first": staff.dedup_subset_keep_first,
    "dup_report": staff.dup_report,
    "null_counts": staff.null_counts,
    "missing_report": staff.missing_report,
    "clean_verify": staff.clean_verify,
    "describe_numeric": staff.describe_numeric,
    "staff_detail_pipeline": staff.staff_detail_pipeline,
    "staff_summary_pipeline": staff.staff_summary_pipeline,
    "staff_enrich_pipeline": staff.staff_enrich_pipeline,
    "coerce_numeric": cleaning.coerce_numeric,
    "impute_median": cleaning.impute_median,
    "impute_mode": cleaning.impute_mode,
    "derive_amount": cleaning.derive_amount,
    "clean_orders_pipeline": cleaning.clean_orders_pipeline,
    "dense_row_id": cleaning.dense_row_id,
    "profile_columns": cleaning.profile_columns,
    "describe_all": cleaning.describe_all,
    "describe_all_measures": cleaning.describe_all_measures,
    "describe_numeric_measures": cleaning.describe_numeric_measures,
    "impute_mean_measures": cleaning.impute_mean_measures,
    "impute_by_dtype_measures": cleaning.impute_by_dtype_measures,
    "csv_schema_roundtrip": io_jobs.csv_schema_roundtrip,
    "csv_infer_roundtrip": io_jobs.csv_infer_roundtrip,
    "parquet_roundtrip": io_jobs.parquet_roundtrip,
    "bulk_load_typed": io_jobs.bulk_load_typed,
    "csv_single_file": io_jobs.csv_single_file,
    "partitioned_roundtrip": io_jobs.partitioned_roundtrip,
    "partition_inventory": io_jobs.partition_inventory,
    "format_compare": io_jobs.format_compare,
    "file_metadata": io_jobs.file_metadata,
    "guarded_copy": io_jobs.guarded_copy,
    "copy_verify": io_jobs.copy_verify,
    "copy_report": io_jobs.copy_report,
    "pushdown_scan": io_jobs.pushdown_scan,
    "staged_load": io_jobs.staged_load,
    "staged_load_lines": io_jobs.staged_load_lines,
    "staged_load_stock": io_jobs.staged_load_stock,
    "staged_load_rejected": io_jobs.staged_load_rejected,
    "merge_touched_files": io_jobs.merge_touched_files,
    "load_key_check": io_jobs.load_key_check,
    "format_measured": io_jobs.format_measured,
    "validate_counts": io_jobs.validate_counts,
    "validate_new_keys": io_jobs.validate_new_keys,
    "table_lifecycle": io_jobs.table_lifecycle,
    "integrity_suite": io_jobs.integrity_suite,
    "clean_orders_detail": cleaning.clean_orders_detail,
    "validate_split": io_jobs.validate_split,
    "dq_suite": io_jobs.dq_suite,
    "filter_in": staff.filter_in,
    "filter_null": staff.filter_null,
    "filter_sql_expr": staff.filter_sql_expr,
    "dq_not_null": staff.dq_not_null,
    "buyer_type": sales.buyer_type,
    "sales_tier": sales.sales_tier,
    **stored.QUERIES,
}
