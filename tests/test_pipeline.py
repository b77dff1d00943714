"""CSV files to gold tables, twice, and the star SQL on the published views."""

from granary.plans import pipeline

FILES = {
    "customers": "customer_id,zip,city,signup_date,gender,age_group,acquisition_channel\n"
                 "1,01234,Hue,2012-02-01,Female,25-34,direct\n2,01235,Da Nang,2012-03-01,male,55+,Referral\n",
    "geography": "zip,city,region,district\n01234,Hue,Central,D1\n01235,Da Nang,central,D2\n",
    "orders": "order_id,order_date,customer_id,zip,order_status,payment_method,device_type,order_source\n"
              "10,2013-07-06,1,01234,Delivered,cod,mobile,direct\n11,2013-07-07,2,01235,cancelled,paypal,desktop,ads\n",
    "order_items": "order_id,product_id,quantity,unit_price,discount_amount,promo_id,promo_id_2\n"
                   "10,5,2,100.5,20.0,PROMO-0001,\n10,6,1,50.0,,,\n11,5,1,100.0,0,,\n",
    "products": "product_id,product_name,category,segment,size,color,price,cogs\n"
                "5,Cap,Outdoor,Everyday,S,red,120,60\n6,Tee,GenZ,Trendy,M,blue,60,30\n",
    "promotions": "promo_id,promo_name,promo_type,discount_value,start_date,end_date,applicable_category,promo_channel,"
                  "stackable_flag,min_order_value\n"
                  "PROMO-0001,Summer,percentage,10.0,2013-06-01,2013-07-31,,email,1,0\n",
    "payments": "order_id,payment_method,payment_value,installments\n10,cod,231,1\n11,paypal,100,3\n",
    "shipments": "order_id,ship_date,delivery_date,shipping_fee\n10,2013-07-07,2013-07-10,3.5\n",
    "returns": "return_id,order_id,product_id,return_date,return_reason,return_quantity,refund_amount\n"
               "R1,10,5,2013-07-20,Defective,1,90.5\n",
    "reviews": "review_id,order_id,product_id,customer_id,review_date,rating,review_title\nV1,10,5,1,2013-07-21,5, Good \n",
    "inventory": "snapshot_date,product_id,stock_on_hand,units_received,units_sold,stockout_days,days_of_supply,fill_rate,"
                 "stockout_flag,overstock_flag,reorder_flag,sell_through_rate,product_name,category,segment,year,month\n"
                 "2013-07-31,5,10,12,2,0,30,1.0,0,0,0,0.2,Cap,Outdoor,Everyday,2013,7\n",
    "sales_daily": "Date,Revenue,COGS\n2013-07-06,231,180\n2013-07-07,100,140\n",
    "web_traffic": "date,sessions,unique_visitors,page_views,bounce_rate,avg_session_duration_sec,traffic_source\n"
                   "2013-07-06,10,8,30,0.4,90.5,direct\n",
}


def test_files_to_gold_twice(spark, tmp_path):
    sources = {}
    for name, text in FILES.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        sources[name] = str(path)
    for _ in range(2):
        ingested, report = pipeline.run(spark, sources, str(tmp_path / "lake"), ("2012-01-01", "2014-01-01"),
                                        check_header=True)
    assert {row.table_name: row.invalid_rows for row in ingested.collect()} == dict.fromkeys(FILES, 0)
    assert {row.status for row in report.collect()} == {"built", "checked"}
    rows = spark.sql("""
        select d.year, c.region, p.category, pr.promo_type, count(distinct f.order_id) as num_orders,
          sum(f.net_amount) as revenue
        from fact_order_items f join dim_date d on f.date_key = d.date_key
        join dim_customer c on f.customer_key = c.customer_id join dim_product p on f.product_key = p.product_id
        join dim_promotion pr on f.promo_key = pr.promo_id
        where d.is_weekend group by all order by revenue desc, category""").collect()
    assert [tuple(row) for row in rows] == [
        (2013, "central", "outdoor", "percentage", 1, 181.0), (2013, "central", "outdoor", "none", 1, 100.0),
        (2013, "central", "genz", "none", 1, 50.0)]
    assert spark.sql("select _margin_negative from bronze_sales_daily order by sale_date").collect()[1][0]
    daily = spark.sql("select * from gold_revenue_daily order by order_date").first()
    assert (daily.num_orders, daily.num_lines, daily.revenue, daily.avg_order_value) == (1, 2, 231.0, 231.0)
