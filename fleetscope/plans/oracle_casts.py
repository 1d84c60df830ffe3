"""Generated by tools/gen_oracle_casts.py: integer widths applied around each DuckDB oracle
so its column types equal the Spark result (DuckDB widens integer sums to HUGEINT)."""

CASTS = {'a8_collection_completeness': {'error_lines': 'BIGINT'},
 'b8_line_count': {'mssql_lines': 'INTEGER', 'pg_lines': 'INTEGER'},
 'c11_snapshot_intervals': {'max_snap_id': 'INTEGER', 'min_snap_id': 'INTEGER'},
 'c11_snapshot_intervals_awr': {'max_snap_id': 'INTEGER', 'min_snap_id': 'INTEGER'},
 'c14_statement_profile': {'rank': 'INTEGER'},
 'c14_top_statements': {'elapsed': 'BIGINT',
                        'executions': 'BIGINT',
                        'rank': 'INTEGER',
                        'rows_processed': 'BIGINT'},
 'c14_top_statements_111': {'elapsed': 'BIGINT',
                            'executions': 'BIGINT',
                            'physical_read_bytes_total': 'BIGINT',
                            'physical_write_bytes_total': 'BIGINT',
                            'rank': 'INTEGER',
                            'rows_processed': 'BIGINT'},
 'c14_top_statements_bytes': {'elapsed': 'BIGINT',
                              'executions': 'BIGINT',
                              'rank': 'INTEGER',
                              'rows_processed': 'BIGINT'},
 'c16_backup_volume': {'elapsed_seconds': 'BIGINT'},
 'c17_hour_matrix_count': {'day_of_month': 'INTEGER',
                           'h0_count': 'BIGINT',
                           'h10_count': 'BIGINT',
                           'h11_count': 'BIGINT',
                           'h12_count': 'BIGINT',
                           'h13_count': 'BIGINT',
                           'h14_count': 'BIGINT',
                           'h15_count': 'BIGINT',
                           'h16_count': 'BIGINT',
                           'h17_count': 'BIGINT',
                           'h18_count': 'BIGINT',
                           'h19_count': 'BIGINT',
                           'h1_count': 'BIGINT',
                           'h20_count': 'BIGINT',
                           'h21_count': 'BIGINT',
                           'h22_count': 'BIGINT',
                           'h23_count': 'BIGINT',
                           'h2_count': 'BIGINT',
                           'h3_count': 'BIGINT',
                           'h4_count': 'BIGINT',
                           'h5_count': 'BIGINT',
                           'h6_count': 'BIGINT',
                           'h7_count': 'BIGINT',
                           'h8_count': 'BIGINT',
                           'h9_count': 'BIGINT'},
 'c17_hour_matrix_size': {'day_of_month': 'INTEGER',
                          'h0_size_in_mb': 'BIGINT',
                          'h10_size_in_mb': 'BIGINT',
                          'h11_size_in_mb': 'BIGINT',
                          'h12_size_in_mb': 'BIGINT',
                          'h13_size_in_mb': 'BIGINT',
                          'h14_size_in_mb': 'BIGINT',
                          'h15_size_in_mb': 'BIGINT',
                          'h16_size_in_mb': 'BIGINT',
                          'h17_size_in_mb': 'BIGINT',
                          'h18_size_in_mb': 'BIGINT',
                          'h19_size_in_mb': 'BIGINT',
                          'h1_size_in_mb': 'BIGINT',
                          'h20_size_in_mb': 'BIGINT',
                          'h21_size_in_mb': 'BIGINT',
                          'h22_size_in_mb': 'BIGINT',
                          'h23_size_in_mb': 'BIGINT',
                          'h2_size_in_mb': 'BIGINT',
                          'h3_size_in_mb': 'BIGINT',
                          'h4_size_in_mb': 'BIGINT',
                          'h5_size_in_mb': 'BIGINT',
                          'h6_size_in_mb': 'BIGINT',
                          'h7_size_in_mb': 'BIGINT',
                          'h8_size_in_mb': 'BIGINT',
                          'h9_size_in_mb': 'BIGINT'},
 'c3_join_snapshots': {'snap_id': 'INTEGER'},
 'c4_snapshot_window': {'max_snap_id': 'INTEGER', 'min_snap_id': 'INTEGER'},
 'd12_schema_details': {'function_bytes': 'BIGINT', 'table_bytes': 'BIGINT'},
 'd15_database_rollup': {'innodb_data_bytes': 'BIGINT',
                         'innodb_index_bytes': 'BIGINT',
                         'innodb_indexes': 'BIGINT',
                         'innodb_rows': 'BIGINT',
                         'innodb_tables': 'BIGINT',
                         'innodb_total_bytes': 'BIGINT',
                         'other_data_bytes': 'BIGINT',
                         'other_index_bytes': 'BIGINT',
                         'other_indexes': 'BIGINT',
                         'other_rows': 'BIGINT',
                         'other_tables': 'BIGINT',
                         'other_total_bytes': 'BIGINT',
                         'total_data_bytes': 'BIGINT',
                         'total_index_bytes': 'BIGINT',
                         'total_indexes': 'BIGINT',
                         'total_rows': 'BIGINT',
                         'total_tables': 'BIGINT',
                         'total_total_bytes': 'BIGINT'},
 'd17_lob_sizing': {'lob_bytes': 'BIGINT'},
 'd21_source_code_by_object': {'nr_lines': 'INTEGER'},
 'd21_source_code_metrics': {'count_dbms_sql': 'BIGINT',
                             'count_exec_im': 'BIGINT',
                             'sum_count_total': 'BIGINT',
                             'sum_nr_lines': 'BIGINT',
                             'sum_nr_lines_w_dbms': 'BIGINT',
                             'sum_nr_lines_w_dbms_utl': 'BIGINT',
                             'sum_nr_lines_w_utl': 'BIGINT'},
 'd22_routine_details': {'num_chars': 'INTEGER', 'num_lines': 'INTEGER'},
 'd25_table_list_mssql': {'row_count': 'BIGINT'},
 'd26_index_list_mssql': {'included_columns': 'BIGINT',
                          'key_ordinal_sum': 'BIGINT',
                          'partition_ordinal_sum': 'BIGINT'},
 'd27_object_list_mssql': {'lines_of_code': 'BIGINT'},
 'd29_container_memory': {'pga_bytes': 'BIGINT', 'sga_bytes': 'BIGINT'},
 'd2_data_type_matrix': {'anydata_col_count': 'BIGINT',
                         'bfile_col_count': 'BIGINT',
                         'binary_double_col_count': 'BIGINT',
                         'binary_float_col_count': 'BIGINT',
                         'blob_col_count': 'BIGINT',
                         'cfile_col_count': 'BIGINT',
                         'char_col_count': 'BIGINT',
                         'clob_col_count': 'BIGINT',
                         'date_col_count': 'BIGINT',
                         'float_col_count': 'BIGINT',
                         'interval_day_to_second_col_count': 'BIGINT',
                         'interval_year_to_month_col_count': 'BIGINT',
                         'json_col_count': 'BIGINT',
                         'long_col_count': 'BIGINT',
                         'long_raw_col_count': 'BIGINT',
                         'mlslabel_col_count': 'BIGINT',
                         'nchar_col_count': 'BIGINT',
                         'nchar_varying_col_count': 'BIGINT',
                         'nclob_col_count': 'BIGINT',
                         'number_col_count': 'BIGINT',
                         'nvarchar2_col_count': 'BIGINT',
                         'raw_col_count': 'BIGINT',
                         'rowid_col_count': 'BIGINT',
                         'spatial_col_count': 'BIGINT',
                         'time_col_count': 'BIGINT',
                         'time_with_time_zone_col_count': 'BIGINT',
                         'timestamp_col_count': 'BIGINT',
                         'timestamp_with_local_time_zone_col_count': 'BIGINT',
                         'timestamp_with_time_zone_col_count': 'BIGINT',
                         'undefined_col_count': 'BIGINT',
                         'urowid_col_count': 'BIGINT',
                         'user_defined_col_count': 'BIGINT',
                         'varchar2_col_count': 'BIGINT',
                         'varchar_col_count': 'BIGINT',
                         'xmltype_col_count': 'BIGINT'},
 'd7_constraint_matrix': {'ck': 'BIGINT',
                          'hashexpr': 'BIGINT',
                          'pk': 'BIGINT',
                          'refcolcons': 'BIGINT',
                          'ri': 'BIGINT',
                          'suplog': 'BIGINT',
                          'uk': 'BIGINT',
                          'vwck': 'BIGINT',
                          'vwro': 'BIGINT'},
 'd8_constraint_summary_by_owner': {'ck': 'BIGINT',
                                    'hashexpr': 'BIGINT',
                                    'pk': 'BIGINT',
                                    'refcolcons': 'BIGINT',
                                    'ri': 'BIGINT',
                                    'suplog': 'BIGINT',
                                    'total_cons': 'BIGINT',
                                    'uk': 'BIGINT',
                                    'vwck': 'BIGINT',
                                    'vwro': 'BIGINT'}}
